"""Readers: topics, change records, dimension tables."""
