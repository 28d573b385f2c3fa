"""Structured Streaming forms of the ingest (incremental, checkpointed, exactly-once)."""
