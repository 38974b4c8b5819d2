"""Operators for building training data from raw text, their queries and check SQL."""
