"""Whole assets: cleaned tables, dimensions, facts, marts, catalogues and models."""
