"""Registered queries: each applies operators of the library to feeds derived from the given tables."""
