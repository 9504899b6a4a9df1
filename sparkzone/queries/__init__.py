"""The operators bound to the given tables, each with the SQL that must agree with it."""

from __future__ import annotations

from .registry import QUERIES, SQL

from . import structured, texts, documents, images, vectors, governed, streams, learned, landing, gated, stored  # noqa: E402,F401 - they register themselves

__all__ = ["QUERIES", "SQL"]
