"""Logical dates: every output is stamped from an argument, never from the wall clock."""

from __future__ import annotations

from datetime import datetime, timezone


def parse(value: datetime | str) -> datetime:
    if value is None:
        raise ValueError("a logical date is required")
    if isinstance(value, str):
        value = datetime.fromisoformat(value.replace("Z", "+00:00"))
    if not isinstance(value, datetime):
        raise TypeError(f"not a logical date: {value!r}")
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def iso(value) -> str:
    return parse(value).isoformat()


def epoch_millis(value) -> str:
    return str(int(parse(value).timestamp() * 1000))


def hive_partition(value) -> str:
    return parse(value).strftime("year=%Y/month=%m/day=%d")


def compact_day(value) -> str:
    return parse(value).strftime("%Y%m%d")
