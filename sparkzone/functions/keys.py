"""Row fingerprints and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed values of the fingerprint text.
FIELD_SEPARATOR = chr(31)
NULL_MARK = "<NULL>"


def _as_columns(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def fingerprint(*cols: Column | str) -> Column:
    """md5 of length-prefixed fields: no two different rows share a text."""
    fields = []
    for c in _as_columns(cols):
        text = c.cast("string")
        fields.append(F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARK)))
    return F.md5(F.concat_ws(FIELD_SEPARATOR, *fields))


def surrogate_key(*cols: Column | str) -> Column:
    """Dimension key. Null position matters, unlike with Spark's own hash functions."""
    return fingerprint(*cols)


def stable_key(*cols: Column | str) -> Column:
    """sha1 over bar-joined fields, missing ones as empty text."""
    return F.sha1(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in _as_columns(cols)]))


def file_key(*cols: Column | str) -> Column:
    """sha256 over double-bar-joined fields, missing ones as empty text."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(c.cast("string"), F.lit("")) for c in _as_columns(cols)]), 256)


def event_digest(payload: Column) -> Column:
    return F.substring(F.sha2(payload, 256), 1, 16)


def offset_digest(offsets_json: Column) -> Column:
    return F.substring(F.md5(offsets_json), 1, 12)
