"""Upkeep of a published vector collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.vectors import needs_rebuild
from ..sources import versions
from ..sources.tables import upsert


def refresh(spark: SparkSession, rows: DataFrame, root: str, key: str = "id", newest: str = "created_at") -> bool:
    """Rows into the collection at ``root``; True if it was built anew from them.

    A collection that lacks a field can't take rows of the present form: they replace it.
    Readers see the former version until the new one is whole.
    """
    stored = versions.read(spark, root) if versions.latest(spark, root) >= 0 else None
    anew = stored is None or needs_rebuild(stored)
    versions.publish(rows if anew else upsert(stored, rows, key, newest), root)
    return anew
