"""Paths through the Hadoop file system, so any storage Spark reads will do."""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, p = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _local(fs, path) -> str | None:
    """Where a path of a local file system lies, mounts resolved; None for any other."""
    folder = fs.resolvePath(path.getParent()).toUri()
    if folder.getScheme() not in (None, "file"):
        return None
    return os.path.join(folder.getPath(), path.getName())


def claim(spark: SparkSession, path: str, owner: str) -> bool:
    """Create a file that holds ``owner`` if it is not there; False if another has it.

    The file system's own exclusive create decides. Hadoop's local file system looks first and
    creates afterwards, so there the operating system's is used. What was written is read back: where
    a store lets the last writer win, the owner it names is the winner.
    """
    fs, target = _fs(spark, path)
    fs.mkdirs(target.getParent())
    local = _local(fs, target)
    try:
        if local is None:
            stream = fs.create(target, False)
            try:
                stream.write(owner.encode("utf-8"))
            finally:
                stream.close()
        else:
            with open(local, "x", encoding="utf-8") as file:
                file.write(owner)
    except (FileExistsError, Py4JJavaError):
        if not fs.exists(target):
            raise
        return False
    return read_text(spark, path) == owner


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that only its owner writes; a reader may see it before it is complete."""
    fs, target = _fs(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def remove_if_empty(spark: SparkSession, folder: str) -> None:
    """Delete a folder that holds nothing."""
    fs, p = _fs(spark, folder)
    if fs.exists(p) and not fs.listStatus(p):
        fs.delete(p, False)
