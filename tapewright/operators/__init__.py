"""Operators over market-data tables: each takes and returns DataFrames."""
