"""Readers for the raw listing, area and review files."""
