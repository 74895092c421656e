"""Small tables made from values at hand, as literals in the plan."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0, 0, 1, 1).select(*nothing)


def small_table(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A few rows of plain values; made in the JVM, with no Python workers behind it."""
    records = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields, strict=True)])
        for row in rows
    ]
    if not records:
        return empty_table(spark, schema)
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*records)))
