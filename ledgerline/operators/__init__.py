"""Lending operators; each takes and returns DataFrames."""
