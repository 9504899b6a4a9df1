"""Tables in versions: written whole, made current by one atomic rename, kept until cleaned.

``root/data/<name>`` holds what a version wrote, ``root/commits/<number>.json`` says which
folder a version is. A version exists once its commit does: a job that fails before leaves a
folder no reader looks at, and readers of an older version go on undisturbed, so a table may be
replaced by a frame that reads it. A commit is a finished small file renamed to the next number;
the rename fails if another writer had that number first.

For file systems whose rename is atomic and refuses an existing target, as HDFS and viewfs do.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import sharedfs

DIGITS = 12


class Conflict(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class Staged:
    """Written rows that are not yet a version; ``after`` is the version they replace (-1: none)."""

    root: str
    folder: str
    after: int


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all versions not yet cleaned, ascending."""
    commits = f"{root.rstrip('/')}/commits"
    if not sharedfs.exists(spark, commits):
        return []
    names = (p.rsplit("/", 1)[-1] for p in sharedfs.data_files(spark, commits))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def latest(spark: SparkSession, root: str) -> int:
    return max(versions(spark, root), default=-1)


def _commit_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/commits/{version:0{DIGITS}d}.json"


def _folder(spark: SparkSession, root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{json.loads(sharedfs.read_text(spark, _commit_path(root, version)))['folder']}"


def stage(frame: DataFrame, root: str, partition_by: tuple[str, ...] = ()) -> Staged:
    """Write the rows of the next version. Nobody sees them before ``commit``."""
    after = latest(frame.sparkSession, root)
    folder = f"data/{uuid.uuid4().hex}"
    writer = frame.write.partitionBy(*partition_by) if partition_by else frame.write
    writer.parquet(f"{root.rstrip('/')}/{folder}")
    return Staged(root, folder, after)


def commit(spark: SparkSession, staged: Staged) -> int:
    """Make staged rows the current version; ``Conflict`` if the version they replace is no longer the current one."""
    version = staged.after + 1
    made = f"{staged.root.rstrip('/')}/commits/.{uuid.uuid4().hex}"
    sharedfs.write_text(spark, made, json.dumps({"version": version, "folder": staged.folder}))
    try:
        sharedfs.rename_new(spark, made, _commit_path(staged.root, version))
    except FileExistsError as taken:
        sharedfs.delete(spark, made)
        raise Conflict(f"{staged.root} has a version {version} already") from taken
    return version


def publish(frame: DataFrame, root: str, partition_by: tuple[str, ...] = ()) -> int:
    """The frame as the table's next version; it may read the table."""
    return commit(frame.sparkSession, stage(frame, root, partition_by))


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The current version, or a former one."""
    version = latest(spark, root) if version is None else version
    if version < 0:
        raise FileNotFoundError(f"{root} has no version")
    return spark.read.parquet(_folder(spark, root, version))


def clean(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the last ``keep`` versions: the commit first, so that no reader finds half a table.

    Folders without a commit stay: one may be of a writer at work. Returns the versions removed.
    """
    gone = versions(spark, root)[: -max(1, keep)]
    for version in gone:
        folder = _folder(spark, root, version)
        sharedfs.delete(spark, _commit_path(root, version))
        sharedfs.delete(spark, folder)
    return gone
