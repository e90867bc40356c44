"""Relational and model operators; each takes and returns DataFrames."""
