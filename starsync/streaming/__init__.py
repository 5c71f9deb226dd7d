"""The incremental behaviour as Structured Streaming jobs."""
