"""Operators on DataFrames: rows, joins, ordered windows, gates, integrity, vectors."""
