"""Queries over the given test tables and their independent SQL counterparts."""
