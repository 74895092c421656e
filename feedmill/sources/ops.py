"""Ops as a table or as a stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from feedmill.schemas import OPS_FLAGS, OPS_SCHEMA


def ops_schema(with_flags: bool = False) -> T.StructType:
    return T.StructType(OPS_SCHEMA.fields + OPS_FLAGS.fields) if with_flags else OPS_SCHEMA


def read_ops(spark: SparkSession, path: str, with_flags: bool = False) -> DataFrame:
    """A Parquet table of ops: index and delete ops in one, told apart by `op`.

    `with_flags` reads `created` and `found` from a source that supplies them.
    """
    return spark.read.schema(ops_schema(with_flags)).parquet(path)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
    file_glob: str | None = None,
) -> DataFrame:
    """Parquet files as they arrive in a folder.

    Intake is bounded per micro-batch by `max_files` or `max_bytes`; what does
    not fit waits for the next one and is never dropped.
    """
    options = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes, "pathGlobFilter": file_glob}
    given = {key: value for key, value in options.items() if value is not None}
    return spark.readStream.schema(schema).options(**given).parquet(path)


def stream_ops(
    spark: SparkSession,
    path: str,
    with_flags: bool = False,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """Ops as they arrive in a folder of Parquet files."""
    return stream_files(spark, path, ops_schema(with_flags), max_files, max_bytes)
