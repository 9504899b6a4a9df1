"""Names of columns, document keys, tables and topics (plain strings, driver side)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence
from itertools import count

from pyspark.sql import DataFrame

# Folders that hold no dataset.
RESERVED_FOLDERS = ("raw", "_staging", "file_catalog")


def _words(text: str) -> list[str]:
    return re.findall(r"[0-9A-Za-z]+", text)


def header_name(raw: str, position: int) -> str:
    """One source header in lower snake case; parentheses vanish, other marks separate."""
    name = "_".join(_words(re.sub(r"[﻿()]", "", str(raw)))).lower() or f"column_{position + 1}"
    if name == "tweet_id":
        name = "id"
    return f"col_{name}" if name[0].isdigit() else name


def header_names(raw: Sequence[str]) -> list[str]:
    """All headers; later uses of a name get the next of ``_2``, ``_3``, ... that no header has."""
    plain = [header_name(header, position) for position, header in enumerate(raw)]
    taken, names = set(plain), []
    used: Counter[str] = Counter()
    for name in plain:
        used[name] += 1
        unique = name
        if used[name] > 1:
            unique = next(n for k in count(used[name]) if (n := f"{name}_{k}") not in taken)
            taken.add(unique)
        names.append(unique)
    return names


def normalize_headers(df: DataFrame) -> DataFrame:
    # toDF renames by position: withColumnRenamed would match ID and id alike.
    return df.toDF(*header_names(df.columns))


def document_key(raw: str) -> str:
    """One JSON key: ASCII only, lower snake case."""
    return "_".join(_words(str(raw).encode("ascii", "ignore").decode().lower()))


def is_dataset_folder(folder: str) -> bool:
    return folder not in RESERVED_FOLDERS and not folder.startswith(".")


def table_name(path: str) -> str | None:
    """Stable table name for a landing folder, or None where it holds no dataset."""
    folder = path.rstrip("/").rsplit("/", 1)[-1]
    if not is_dataset_folder(folder):
        return None
    stem = re.sub(r"_\d+$", "", folder.replace("_delta", ""))
    stem = re.sub(r"(?i)_\d{8}t\d{6}$", "", stem)
    return "_".join(_words(stem)).lower() or None


def topic_table(topic: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", topic).lower().strip("_")


def pick_column(columns: Iterable[str], candidates: Sequence[str], required: bool = True) -> str | None:
    """The first candidate that exists; producers do not agree on column names."""
    available = set(columns)
    found = next((c for c in candidates if c in available), None)
    if found is None and required:
        raise KeyError(f"none of {list(candidates)} among {sorted(available)}")
    return found
