"""Operators that prepare text, vectors, pages and conversations for training. Nothing outside this package imports it."""
