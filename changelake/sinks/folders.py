"""Small file system calls, through the file systems Spark is set up with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers n of the folders `<path>/<prefix><n>`, ascending."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.create(p, True).close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def size(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file, null where it is gone."""
    fs, p = _path(spark, path)
    return fs.getFileStatus(p).getLen() if fs.exists(p) else None


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the parents of what a pattern finds."""
    fs, p = _path(spark, pattern)
    return [status.getPath().getParent().getName() for status in fs.globStatus(p) or []]


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, the oldest first; none where it doesn't exist."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in sorted(fs.listStatus(p), key=lambda s: (s.getModificationTime(), s.getPath().getName()))]


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, p = _path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0
