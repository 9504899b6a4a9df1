"""Cleaning of JSON documents of any shape into maps of trusted fields."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .. import logicaldate
from ..functions.labels import governance_columns
from ..functions.names import topic_table
from ..operators.gates import require_not_empty
from ..operators.rows import computed_once, once
from ..sources.documents import flatten_snapshots
from ..sources.tables import overwrite, replace_partitions

# Fields a document must carry, and topics that hold station snapshots.
REQUIRED_FIELDS = {
    "weather_barcelona": ("time", "temperature"),
    "airquality_barcelona": ("id", "name", "locality", "coordinates"),
}
STATION_TOPICS = ("airquality_barcelona",)
FLAT_PARENTS = ("country", "owner", "provider")
FLAT_FIELDS = ("id", "name", "code")


@dataclass(frozen=True)
class CleanedDocuments:
    valid: DataFrame
    rejected: DataFrame
    day: str


def clean_key(c: Column) -> Column:
    """One document key: ASCII only, lower snake case."""
    low = F.lower(F.trim(c))
    ascii_only = F.trim(F.regexp_replace(low, r"[^\x00-\x7F]", ""))
    squeezed = F.regexp_replace(F.regexp_replace(ascii_only, r"[^a-z0-9_]+", "_"), "_+", "_")
    return F.when(low.rlike("[^a-z0-9]"), F.trim(squeezed, F.lit("_"))).otherwise(low)


# A text value that itself starts like JSON; documents without one need no second parse.
TEXT_LIKE_JSON = r'":\s*"[{\[]'
# No text holds it unescaped; it parts the keys of a document while they are cleaned together.
KEY_END = "\u0001"
PLAIN_KEY = "abcdefghijklmnopqrstuvwxyz0123456789"


def starts_nested(c: Column) -> Column:
    return F.startswith(c, F.lit("{")) | F.startswith(c, F.lit("["))


def _clean_keys(keys: Column) -> Column:
    """``clean_key`` of each key; joined and lower-cased they are split where all are letters and digits."""

    def cleaned(low: Column) -> Column:
        split = F.split(low, KEY_END)
        # Taking known characters away costs a tenth of a pattern over the whole text.
        plain = (F.translate(low, PLAIN_KEY + KEY_END, "") == "") & (F.size(split) == F.size(keys))
        return F.when(plain, split).otherwise(F.transform(keys, clean_key))

    return once(F.lower(F.array_join(keys, KEY_END)), cleaned)


def _plain(text: Column) -> Column:
    """Text of a JSON value: strings trimmed and lower-cased, nested values as JSON."""
    return F.when(starts_nested(text), text).otherwise(F.lower(F.trim(text)))


def _plain_typed(entry: Column, typed: Column) -> Column:
    """The same where a string may itself look like JSON: ``typed`` tells them apart."""
    text = entry["value"]
    is_text = F.coalesce(F.startswith(F.to_json(F.try_element_at(typed, entry["key"])), F.lit('"')), F.lit(False))
    return F.when(starts_nested(text) & ~is_text, text).otherwise(F.lower(F.trim(text)))


def _last_wins(entries: Column) -> Column:
    """Two keys may clean to one name; the later entry is kept, as in a dictionary."""
    return F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0))), lambda later: later["key"] == e["key"]),
    )


def _texts(record: Column, raw: Column) -> Column:
    """Text of each value of a record; only one with a text that looks nested is parsed for its types."""
    # The plain search spares most records the pattern.
    quoted = F.contains(record, F.lit('"{')) | F.contains(record, F.lit('"['))
    typed = lambda types: F.transform(F.map_entries(raw), lambda e: _plain_typed(e, types))
    by_type = once(F.from_json(record, "map<string,variant>"), lambda types: F.when(types.isNotNull(), typed(types)))
    plain = F.transform(F.map_values(raw), _plain)
    return F.when(quoted & record.rlike(TEXT_LIKE_JSON), F.coalesce(by_type, plain)).otherwise(plain)


# Nested parts of a station that become fields of their own; one parse finds them all.
PARTS = f"struct<{', '.join(f'{p}: struct<{", ".join(f"{n}: STRING" for n in FLAT_FIELDS)}>' for p in FLAT_PARENTS)}, coordinates: struct<latitude: STRING, longitude: STRING>>"
FLAT_NAMES = [f"{p}_{n}" for p in FLAT_PARENTS for n in FLAT_FIELDS] + ["latitude", "longitude"]


def _flat_texts(parts: Column) -> Column:
    flat = [F.lower(F.trim(parts[p][n])) for p in FLAT_PARENTS for n in FLAT_FIELDS]
    return F.array(*flat, *[parts["coordinates"][n] for n in ("latitude", "longitude")])


def _cleaned_map(record: Column, stations: bool) -> Column:
    """One expression from JSON text to map: what is used more than once is bound within it, and no row is copied between its steps."""

    def joined(raw: Column, flat: Column | None) -> Column:
        names, texts = _clean_keys(F.map_keys(raw)), _texts(record, raw)
        if flat is not None:
            there = F.filter(F.array(*[F.lit(n) for n in FLAT_NAMES]), lambda _, i: F.get(flat, i).isNotNull())
            names, texts = F.concat(names, there), F.concat(texts, F.array_compact(flat))
        return once(names, lambda keys: once(texts, lambda values: _as_map(keys, values)))

    def cleaned(raw: Column) -> Column:
        if not stations:
            return joined(raw, None)
        return once(F.from_json(record, PARTS), lambda parts: once(_flat_texts(parts), lambda flat: joined(raw, flat)))

    return once(F.from_json(record, "map<string,string>"), cleaned)


def normalize_records(docs: DataFrame, stations: bool) -> DataFrame:
    """``record`` (JSON text) to ``doc`` (map of cleaned keys to text); records that are no objects drop out."""
    flat = flatten_snapshots(docs) if stations else docs.filter(F.startswith(F.ltrim("record"), F.lit("{")))
    return computed_once(flat, "doc", _cleaned_map(F.col("record"), stations)).drop("record")


def _as_map(keys: Column, values: Column) -> Column:
    entries = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("key"), v.alias("value")))
    distinct = F.size(F.array_distinct(keys)) == F.size(keys)
    return F.when(~distinct, once(entries, lambda listed: F.map_from_entries(_last_wins(listed)))).otherwise(F.map_from_arrays(keys, values))


def field(doc: str, name: str) -> Column:
    return F.try_element_at(F.col(doc), F.lit(name))


def split_required_fields(docs: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    complete = F.lit(True)
    for name in required:
        complete = complete & field("doc", name).isNotNull()
    return docs.filter(complete), docs.filter(~complete)


def clean_documents(docs: DataFrame, topic: str, date, required: Sequence[str] | None = None, stations: bool | None = None) -> CleanedDocuments:
    """Parsed records of one topic and day to trusted documents and rejected ones."""
    table, stamp = topic_table(topic), logicaldate.iso(date)
    required = REQUIRED_FIELDS.get(table, ()) if required is None else required
    stations = table in STATION_TOPICS if stations is None else stations
    normalized = normalize_records(docs, stations)
    good, bad = split_required_fields(normalized, required)
    path = F.col("source_file_path")
    valid = good.select(
        "doc",
        F.lit(logicaldate.compact_day(date)).alias("trusted_partition_date"),
        F.lit(topic).alias("trusted_source_topic"),
        *[c.alias(n) for n, c in governance_columns("kafka", stamp, path).items()],
    )
    rejected = bad.select(
        F.lit("trusted").alias("zone"),
        F.lit("semi_structured_document").alias("asset_type"),
        F.lit(table).alias("dataset_name"),
        F.lit("missing_required_fields").alias("reason"),
        F.array(*[F.lit(r) for r in required]).cast("array<string>").alias("required_fields"),
        F.array_sort(F.map_keys("doc")).alias("record_keys"),
        F.lit(stamp).alias("rejected_at"),
        F.to_json("doc", {"ignoreNullFields": "false"}).alias("raw_record"),
        *[c.alias(n) for n, c in governance_columns("kafka", stamp, path, "rejected", f"{table}_v1").items()],
    )
    return CleanedDocuments(valid, rejected, logicaldate.compact_day(date))


def write_documents(cleaned: CleanedDocuments, topic: str, root: str) -> None:
    """Replace the day's partition of the documents and of what was rejected; a rerun leaves the same tables."""
    table = topic_table(topic)
    require_not_empty(cleaned.valid, table)
    # A rerun without rejects has to clear those of the run before, so the day's folder is replaced as a whole.
    overwrite(cleaned.rejected, f"{root}/{table}_rejected/rejected_day={cleaned.day}")
    replace_partitions(cleaned.valid, f"{root}/{table}", "trusted_partition_date")
