"""Checks on the given tables: queries, their SQL, and the mapping both use."""
