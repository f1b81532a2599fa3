"""Structured Streaming: runners, exactly-once writers, the keyed mirror table, partition commits."""
