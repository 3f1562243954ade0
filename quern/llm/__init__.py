"""Operators for building training text from documents. Nothing outside this package imports it."""
