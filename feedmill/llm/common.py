"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from feedmill.sources.folders import scratch_folder

#: Rows of one numbering bucket, about, if they are narrow; a task sorts a few of them.
BUCKET_ROWS = 200_000

#: Rows of a batch that are held as Python values at a time.
SLICE_ROWS = 1024


def _give_back_memory() -> None:
    """Workers live long: what they free goes back to the system, large arrays at once."""
    pa.set_memory_pool(pa.system_memory_pool())
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt is not None:
        mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD: arrays above a megabyte have pages of their own
        mallopt(-8, 2)  # M_ARENA_MAX


_give_back_memory()


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts of at most `SLICE_ROWS` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared scratch folder: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole(text_col: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def bytes_of(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The values of a string or binary column as UTF-8 bytes; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunk at all
            return []
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [v or b"" for v in column.to_pylist()]


def pieces(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items of at most `most` in sum; a larger item stands alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def numbered(df: DataFrame, keys: list[str], order: list[Column], out: str, spread: list[Column], n_rows: int, bucket_rows: int | None = None) -> DataFrame:
    """Gapless numbers from 0 within `keys`, by hash bucket, then `order`.

    A key may hold any share of the rows: it is cut into buckets by the hash of
    `spread`, rows are numbered in their bucket, and buckets start where the one
    before ended. Only the counts of buckets are ever gathered by key. Wide rows
    take fewer `bucket_rows`, as a task sorts whole buckets.
    """
    n_buckets = max(1, n_rows // (bucket_rows or BUCKET_ROWS))
    rows = df.withColumn("__bucket", F.pmod(F.xxhash64(*spread), F.lit(n_buckets)))
    counts = rows.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*keys).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__bucket").alias("__b"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
    )
    inside = W.partitionBy(*keys, "__bucket").orderBy(*order)
    match = F.col("__bucket") == F.col("__b")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    ranked = rows.withColumn("__rank", F.row_number().over(inside))
    return (
        ranked.join(starts, match)
        .withColumn(out, (F.col("__start") + F.col("__rank") - 1).cast("long"))
        .drop("__bucket", "__b", "__rank", "__start", *[f"__k{i}" for i in range(len(keys))])
    )


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def u64(x) -> np.ndarray:
    return np.asarray(x, dtype=np.uint64)
