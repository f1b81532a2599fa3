"""Readers and parsers: from files, topics and messages to change rows."""
