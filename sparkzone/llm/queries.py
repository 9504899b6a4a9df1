"""Each operator applied to its whole table, with production parameters."""

from __future__ import annotations

from .registry import QUERIES, SQL

from . import queries_free, queries_native  # noqa: E402,F401 - they register themselves

__all__ = ["QUERIES", "SQL"]
