"""Cleaning of structured tables: one pass over the source, failures kept apart."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StringType

from .. import logicaldate
from ..functions import numbers, text
from ..functions.keys import fingerprint
from ..functions.labels import governance_columns
from ..functions.names import normalize_headers
from ..operators import gates
from ..operators.rows import any_filled, fill_keys, keep_first, rejection_event
from .rules import TableRules


@dataclass(frozen=True)
class Cleaned:
    """``valid`` is None where the whole table was rejected for missing columns."""

    rules: TableRules
    date: str
    source: str
    valid: DataFrame | None
    rejected: DataFrame
    sort_keys: list[str]
    raw: DataFrame

    def event(self) -> DataFrame:
        """The audit row of the rejection; no row if nothing was rejected."""
        reason = "missing_required_values" if self.valid is not None else "missing_required_columns"
        rows = self.rejected.drop("reason") if self.valid is not None else self.rejected
        return rejection_event(rows, "structured", self.rules.table, self.date, reason, self.source, self.rules.required)

    def audit(self) -> DataFrame:
        """Rows before and after each row-changing step."""
        flagged = standardize(self.raw.withColumn("zz_not_empty", any_filled(self.raw)), self.rules)
        counted = flagged.agg(
            F.count("*").alias("loaded"),
            F.count_if("zz_not_empty").alias("not_empty"),
            F.count_if(F.col("zz_not_empty") & _present(self.rules.required)).alias("complete"),
        )
        counts = counted.select("*", self.valid.agg(F.count("*")).scalar().alias("kept"))
        step = lambda order, name, before, after: F.struct(
            F.lit(order).alias("step_no"),
            F.lit(name).alias("step"),
            F.col(before).alias("before_rows"),
            F.col(after).alias("after_rows"),
        )
        steps = F.array(
            step(1, "drop_empty_rows", "loaded", "not_empty"),
            step(2, "quarantine_invalid_required_rows", "not_empty", "complete"),
            step(3, "deduplicate", "complete", "kept"),
        )
        return counts.select(F.lit(self.rules.table).alias("table"), F.explode(steps).alias("s")).select("table", "s.*")

    def verify(self, expected_rows: int | None = None) -> int:
        """The fatal gates: clean text, unique keys, row count."""
        gates.require_clean_text(self.valid, self.rules.table)
        gates.require_unique(self.valid, self.rules.table, self.rules.unique_keys)
        return gates.require_rows(self.valid, self.rules.table, expected_rows)


def _tidy_layer(df: DataFrame, rules: TableRules) -> list[Column]:
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in rules.text_ids:
            c = c.cast("string")
        if isinstance(f.dataType, StringType) or f.name in rules.text_ids:
            c = text.tidy(c)
        elif isinstance(f.dataType, (FloatType, DoubleType)):
            c = numbers.finite(c)
        columns.append(c.alias(f.name))
    return columns


def _value_layer(df: DataFrame, rules: TableRules) -> list[Column]:
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, StringType):
            c = text.null_tokens(c, text.celsius_unit(c) if f.name in rules.unit_columns else None)
        if f.name in rules.arrays:
            if isinstance(f.dataType, StringType):
                c = text.bracketed_to_array(c)
            if isinstance(f.dataType, (StringType, ArrayType)):
                c = text.clean_array(c)
        if f.name in rules.month_columns:
            c = text.month_range(c)
        columns.append(c.alias(f.name))
    return columns


def _rule_layer(df: DataFrame, rules: TableRules) -> list[Column]:
    columns = []
    for name in df.columns:
        c = F.col(name)
        if name in rules.integers:
            c = c.try_cast("int")
        if name in rules.non_negative:
            c = numbers.non_negative(c)
        if name == "year" and rules.year_range:
            c = numbers.within(c, *rules.year_range)
        columns.append(c.alias(name))
    return columns


def standardize(df: DataFrame, rules: TableRules) -> DataFrame:
    """Headers and values in trusted form; no row is removed.

    Three projections rather than one: each reads the one before, so an
    expensive text expression is computed once and used twice.
    """
    df = normalize_headers(df)
    tidy = df.select(*_tidy_layer(df, rules))
    values = tidy.select(*_value_layer(tidy, rules))
    return values.select(*_rule_layer(values, rules))


def _present(required: tuple[str, ...]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in required], F.lit(True))


def clean_structured(df: DataFrame, rules: TableRules, date, source: str = "") -> Cleaned:
    stamp = logicaldate.iso(date)
    raw = normalize_headers(df)
    # Rows are judged empty before null tokens are known: a row of N/A is not empty.
    cleaned = standardize(raw.filter(any_filled(raw)), rules)
    missing = [c for c in rules.required if c not in raw.columns]
    if missing:
        return Cleaned(rules, stamp, source, None, cleaned, [], raw)

    # Cleaned text is never blank, so presence is all a required value needs.
    complete = _present(rules.required)
    rejected = cleaned.filter(~complete).withColumn("reason", F.lit("missing_required_values"))
    keys = rules.sort_keys_for(cleaned.columns)
    valid = fill_keys(cleaned.filter(complete), keys)
    if rules.whole_row_duplicates:
        valid = valid.dropDuplicates()
    else:
        valid = keep_first(valid, keys, [fingerprint(*valid.columns)])
    valid = valid.withColumns(governance_columns("landing-zone", stamp, source, "valid", rules.schema_version))

    return Cleaned(rules, stamp, source, valid, rejected, keys, raw)
