"""Folders every executor can reach, and existence checks through Hadoop's FileSystem."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="sparkzone-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(frame, label: str = "stage"):
    """Write a frame to the shared folder and read it back.

    The files outlive any executor, and every later branch sees the same rows.
    """
    spark = frame.sparkSession
    path = new_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return bool(fs.exists(target))


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the direct sub-folders; metadata only, never file contents."""
    fs, target = _hadoop_path(spark, path)
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(target) if s.isDirectory())


def count_entries(spark: SparkSession, path: str) -> int:
    """Files and folders directly under a folder, or 1 for a file."""
    fs, target = _hadoop_path(spark, path)
    return len(fs.listStatus(target))


def folder_of(spark: SparkSession, path: str) -> tuple[str, int]:
    """A folder, or that of a file, as its file system names it, and how deep it lies."""
    fs, target = _hadoop_path(spark, path)
    status = fs.getFileStatus(target)
    folder = status.getPath() if status.isDirectory() else status.getPath().getParent()
    return str(folder.toString()), int(folder.depth())


# Entries of a folder that are asked one by one, at several calls into the JVM each; those of a larger folder come from one scan.
FEW_ENTRIES = 1_000


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Non-hidden, non-empty files directly under a folder, or the file itself."""
    fs, target = _hadoop_path(spark, path)
    entries = fs.listStatus(target)
    if len(entries) > FEW_ENTRIES:
        folder = str(entries[0].getPath().getParent().toString())
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).filter("length > 0").select("path")
        named = (r["path"].rpartition("/") for r in listed.collect())
        return sorted(f"{folder}/{name}" for parent, _, name in named if parent == folder and not name.startswith(("_", ".")))
    return sorted(
        str(s.getPath().toString())
        for s in entries
        if s.isFile() and s.getLen() > 0 and not s.getPath().getName().startswith(("_", "."))
    )


def holds_data(spark: SparkSession, path: str) -> bool:
    """Whether any non-empty file lies below a folder; stops at the first hit."""
    fs, target = _hadoop_path(spark, path)
    if not fs.exists(target):
        return False
    walk = fs.listFiles(target, True)
    while walk.hasNext():
        status = walk.next()
        if status.getLen() > 0 and not status.getPath().getName().startswith(("_", ".")):
            return True
    return False


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """A small file, in one piece for readers that list complete files only."""
    fs, target = _hadoop_path(spark, path)
    out = fs.create(target, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, target = _hadoop_path(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def rename_new(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file; ``FileExistsError`` if the target exists."""
    jvm = spark.sparkContext._jvm
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else jvm.java.io.File("/").toURI(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(source, target, none)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise FileExistsError(to) from error
        raise


def delete(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return bool(fs.delete(target, True))
