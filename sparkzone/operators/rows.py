"""Row filters, splits, duplicates and bridges."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import FractionalType, IntegralType, StringType

from ..functions.keys import event_digest, fingerprint


def filled(df: DataFrame, name: str) -> Column:
    """Whether a column holds a value; blank text is none. Never null itself."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, StringType):
        return c.isNotNull() & (F.trim(F.coalesce(c, F.lit(""))) != "")
    return c.isNotNull()


def any_filled(df: DataFrame) -> Column:
    return reduce(or_, [filled(df, c) for c in df.columns])


def all_filled(df: DataFrame, required: Sequence[str]) -> Column:
    return reduce(and_, [filled(df, c) for c in required], F.lit(True))


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is evaluated once per row.

    The optimizer substitutes a projected expression into every filter above it;
    the output of a generator is opaque to that, so an expensive parse is not
    repeated per use. The one-element array keeps every row, null values too.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value, which is evaluated once however often ``use`` names it.

    Unlike ``computed_once`` no row is copied, so several values of a row cost one generator in all.
    An aggregate over no elements hands its start to its last step.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, use)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.filter(any_filled(df)) if df.columns else df


def split_required(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every required value, rows without)."""
    complete = all_filled(df, required)
    return df.filter(complete), df.filter(~complete)


def fill_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null sort keys become ``unknown`` or zero by type."""
    fills = {}
    for name in keys:
        kind = df.schema[name].dataType
        if isinstance(kind, StringType):
            fills[name] = F.coalesce(F.col(name), F.lit("unknown"))
        elif isinstance(kind, (IntegralType, FractionalType)):
            fills[name] = F.coalesce(F.col(name), F.lit(0).cast(kind))
    return df.withColumns(fills) if fills else df


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per key, the first by ``order`` (all other columns unless given).

    ``row_number() <= 1`` is planned with a per-task limit ahead of the exchange,
    so a key with any number of copies sends one row per task.
    """
    order = list(order) if order is not None else [c for c in df.columns if c not in keys] or list(keys)
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("__n = 1").drop("__n")


def later_copies(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The rows ``keep_first`` leaves out, each distinct one with its number of ``copies``.

    Equal rows collapse before the exchange and the survivors are joined back on
    the key, so a huge group of copies is neither ranked nor collected.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("copies")).withColumn("__row", fingerprint(*df.columns))
    # The fingerprint settles ties, so exactly one distinct row per key survives.
    kept = keep_first(counted, keys, [*order, "__row"]).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__row").alias("__kept")
    )
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    left_out = F.col("copies") - (F.col("__row") == F.col("__kept")).cast("int")
    joined = counted.join(kept, same_key).withColumn("copies", left_out)
    return joined.filter("copies > 0").select(*df.columns, "copies")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def latest(df: DataFrame, time: str) -> DataFrame:
    """The one row with the greatest time; rows without a time do not count."""
    picked = df.filter(F.col(time).isNotNull()).orderBy(F.col(time).desc(), fingerprint(*df.columns)).limit(1)
    return picked


def explode_bridge(df: DataFrame, key: str, items: str, out: str, normalize=lambda c: c) -> DataFrame:
    """One row per array element; empty arrays and blank elements vanish."""
    exploded = df.select(key, F.explode(items).alias("__item")).filter("__item <> ''")
    return exploded.select(key, normalize(F.col("__item")).alias(out)).filter(F.col(out) != "")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def histogram(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def rejection_event(
    rejected: DataFrame, domain: str, dataset: str, date: str, reason: str, source: str, required: Sequence[str], samples: int = 5
) -> DataFrame:
    """At most one audit row: how many rows were rejected and a few of them, in a stable order."""
    row = F.to_json(F.struct(*rejected.columns), {"ignoreNullFields": "false"})
    sample = (
        rejected.select(row.alias("row"), fingerprint(*rejected.columns).alias("h"))
        .orderBy("h", "row")
        .limit(samples)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("h", "row"))), lambda s: s["row"]).alias("sample_records"))
    )
    total = rejected.agg(F.count("*").alias("rejected_record_count")).filter("rejected_record_count > 0")
    event = total.select(
        F.lit(dataset).alias("dataset_name"),
        F.lit(domain).alias("domain"),
        F.lit(date).alias("logical_date"),
        F.lit(reason).alias("reason"),
        "rejected_record_count",
        F.array(*[F.lit(c) for c in required]).cast("array<string>").alias("required_columns"),
        sample.scalar().alias("sample_records"),
        F.lit(source).alias("source_file_path"),
        F.lit("rejected").alias("validation_status"),
        F.lit("trusted").alias("zone"),
    )
    return with_event_id(event)


def with_event_id(event: DataFrame) -> DataFrame:
    """Digest of the row as sorted-key JSON: the same rejection always has the same id."""
    payload = F.to_json(F.struct(*sorted(event.columns)), {"ignoreNullFields": "false"})
    return event.withColumn("event_id", event_digest(payload))
