"""Small text files that are found by their names, on any file system that Spark knows."""

import os
import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=64)
def _is_local(application: str, scheme: str) -> bool:
    """Is this the file system of this machine? Asked once per application and kind of path."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{scheme}/")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme() == "file"


def local_path(spark: SparkSession, path: str) -> str | None:
    """Where a path is on this machine, None if it is on another file system."""
    if path.startswith("/"):
        return path if _is_local(spark.sparkContext.applicationId, "") else None
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return None


def hadoop_place(spark: SparkSession, path: str):
    """The file system of a path and the path on it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    local = local_path(spark, path)
    if local:
        return os.path.exists(local)
    fs, target = hadoop_place(spark, path)
    return fs.exists(target)


def last_made(holds: Callable[[int], bool], first: int = 0) -> int:
    """The greatest number from `first` on for which `holds`, of numbers for which it holds up to some point.

    It is taken to hold for `first` itself. Asks as often as the distance has digits, twice.
    """
    low, width = first, 1
    while holds(low + width):
        low, width = low + width, 2 * width
    high = low + width
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if holds(middle) else (low, middle)
    return low


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a file, None if there is none."""
    local = local_path(spark, path)
    if local:
        try:
            with open(local, encoding="utf-8") as file:
                return file.read()
        except FileNotFoundError:
            return None
    fs, target = hadoop_place(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """Write a file or replace it."""
    local = local_path(spark, path)
    if local:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as file:
            file.write(content)
        os.replace(draft, local)
        return
    fs, target = hadoop_place(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(content, "utf-8"))
    out.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    fs, target = hadoop_place(spark, path)
    fs.delete(target, True)
