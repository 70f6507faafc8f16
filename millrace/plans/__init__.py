"""Whole flows: raw files to tables, topics to facts, facts to the mart."""
