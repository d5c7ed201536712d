"""Queries over the given tables, the nested records derived from them, and their SQL."""
