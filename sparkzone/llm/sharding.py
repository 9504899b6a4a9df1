"""Sharding by extendible hashing.

A directory is addressed by the leading bits of a row's hash. A bucket whose rows exceed the
byte limit is split on its next bit, and only that bucket; shards are the buckets that fit.
Bucket sizes are found from a histogram over hash prefixes, a few bits finer than the mean
shard; where a cell of it still exceeds the limit, its rows alone go on to a finer one. The
directory stays a table: neither it nor the rows pass through the driver.

Cases: null text counts no bytes; a row larger than the limit has a shard of its own, the
only kind above the limit; rows equal in id and text share a hash, so they are cut into
numbered parts (``part``) once all bits are used; null ids hash like a text; no rows in give
no rows out; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of, written

BITS = 60
STEP = 8


def hash_bits(doc_id: Column, text: Column) -> Column:
    """60 bits that SQL engines agree on, from the digest of id and text."""
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(text))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, depth: Column) -> Column:
    # The shift by a column needs SQL; shiftright() takes plain numbers only.
    return F.call_function("shiftright", h, (F.lit(BITS) - depth).cast("int"))


def shard_rows(documents: DataFrame, limit_bytes: int) -> DataFrame:
    """doc_id, n_bytes, shard (its hash prefix as bits), depth, part, shard_bytes, shard_rows."""
    if limit_bytes <= 0:
        raise ValueError("limit_bytes must be positive")
    rows = written(
        documents.select("doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"), hash_bits(F.col("doc_id"), text_of()).alias("h")), "shard-rows"
    )
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    coarse, fine = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit_bytes)))) + 3)
    done: DataFrame | None = None
    while True:
        here = rows.withColumn("cell", _prefix(F.col("h"), F.lit(fine)))
        cells = here.groupBy("cell").agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        up = cells.withColumn("depth", F.explode(F.sequence(F.lit(coarse), F.lit(fine))))
        up = up.withColumn("node", F.call_function("shiftright", F.col("cell"), (F.lit(fine) - F.col("depth")).cast("int")))
        nodes = up.groupBy("depth", "node").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
        nodes = nodes.withColumn("fits", (F.col("shard_bytes") <= limit_bytes) | (F.col("shard_rows") == 1) | (F.col("depth") == BITS))
        # A bucket is a node that fits below one that was split.
        split = nodes.where(~F.col("fits")).select((F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("node") * 2, F.col("node") * 2 + 1)).alias("node"))
        fits = nodes.where(F.col("fits")).drop("fits")
        leaves = fits.where(F.col("depth") == coarse).unionByName(fits.where(F.col("depth") > coarse).join(split, ["depth", "node"], "left_semi"))
        # The directory: every prefix of ``fine`` bits points at its bucket. Ranges of buckets
        # don't overlap, so it has 2^fine entries at most, about 8 times the shards.
        width = F.call_function("shiftleft", F.lit(1).cast("long"), (F.lit(fine) - F.col("depth")).cast("int"))
        pointers = leaves.select(F.explode(F.sequence(F.col("node") * width, (F.col("node") + 1) * width - 1)).alias("cell"), F.struct("depth", "node", "shard_bytes", "shard_rows").alias("leaf"))
        placed = written(here.join(pointers, "cell", "left").drop("cell"), "shard-level")
        found = placed.where(F.col("leaf").isNotNull())
        done = found if done is None else done.unionByName(found)
        rows = placed.where(F.col("leaf").isNull()).drop("leaf")
        if fine == BITS or rows.isEmpty():
            break
        coarse, fine = fine + 1, min(BITS, fine + STEP)
    out = done.select("doc_id", "n_bytes", "h", "leaf.*")
    over = (F.col("shard_rows") > 1) & (F.col("shard_bytes") > limit_bytes)
    alike = Window.partitionBy("h").orderBy("doc_id")
    split = out.where(over).withColumn("part", F.floor((F.row_number().over(alike) - 1) / F.greatest(F.lit(1), F.floor(F.lit(limit_bytes) / F.col("n_bytes")))))
    whole = Window.partitionBy("h", "part")
    split = split.withColumn("shard_bytes", F.sum("n_bytes").over(whole)).withColumn("shard_rows", F.count(F.lit(1)).over(whole))
    out = out.where(~over).withColumn("part", F.lit(0).cast("long")).unionByName(split)
    bits = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.conv(F.col("node").cast("string"), 10, 2), F.col("depth"), "0"))
    return out.select("doc_id", "n_bytes", bits.alias("shard"), F.col("depth").cast("long").alias("depth"), "part", "shard_bytes", "shard_rows")


def directory(assigned: DataFrame) -> DataFrame:
    """The shards of ``shard_rows``: shard, depth, part, bytes, rows."""
    return assigned.groupBy("shard", "depth", "part").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows"))
