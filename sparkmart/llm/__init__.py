"""Operators for preparing language-model training data, on plain document tables."""
