"""Structured Streaming: wire records to deduplicated windowed facts."""
