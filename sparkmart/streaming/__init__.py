"""Streaming jobs: topics wired through the operators into topics and tables."""
