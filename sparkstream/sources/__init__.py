"""Readers: literals, sequences, text lines, topics, JDBC, change feeds, catalog tables."""
