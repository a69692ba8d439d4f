"""Folder operations that Spark's readers and writers lack, by Hadoop's file system API.

Works wherever Spark can write (HDFS, object stores, local tests).
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _fs(spark, path)
    return fs.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` (empty where there is none)."""
    target, fs = _fs(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    target, fs = _fs(spark, path)
    fs.delete(target, True)


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there; True for the one caller that made it."""
    target, fs = _fs(spark, path)
    if fs.exists(target):
        return False
    fs.mkdirs(target.getParent())
    if fs.getScheme() == "file":  # whose create() looks first and creates then
        try:
            open(target.toUri().getPath(), "x").close()
        except FileExistsError:
            return False
        return True
    try:
        fs.create(target, False).close()
    except Py4JJavaError:  # a name node or store refuses the second one
        if fs.exists(target):
            return False
        raise
    return True


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of all entries in ``path`` (empty where there is none)."""
    target, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def replace(spark: SparkSession, staged: str, path: str) -> None:
    """Put a complete folder in the place of ``path``: two renames, the old folder goes last."""
    source, fs = _fs(spark, staged)
    target, _ = _fs(spark, path)
    aside, _ = _fs(spark, staged + ".old")
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"cannot move {path} aside")
    if not had:
        fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"cannot move {staged} to {path}")
    if had:
        fs.delete(aside, True)
