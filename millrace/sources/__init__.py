"""Reading and writing: files, Kafka, streaming sinks and the shared folder."""
