"""Queries over the given tables, one per operator, with their SQL counterparts."""
