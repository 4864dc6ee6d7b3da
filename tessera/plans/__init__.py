"""Queries over the given tables, composed from the library's operators."""
