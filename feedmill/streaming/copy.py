"""A consumer that copies the log as a stream, without repeats."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedmill.operators.consume import dedupe
from feedmill.schemas import CHANGE_COLUMNS, CHANGE_SCHEMA
from feedmill.streaming.feed import query_id


def _copied(batch: DataFrame, copy: str, part: str) -> DataFrame | None:
    """What the copy has from other micro-batches, if anything."""
    try:
        schema = T.StructType([*CHANGE_SCHEMA.fields, T.StructField("part", T.StringType())])
        whole = batch.sparkSession.read.schema(schema).parquet(copy)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return whole.where(F.col("part") != part).select(*CHANGE_COLUMNS)


def copy_stream(log: DataFrame, copy: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append what is new in a stream of the log to the Parquet table at `copy`.

    A record is a repeat if the copy has one that agrees in all six columns,
    whenever it came: no clock decides, so late records and backfills are kept.
    Each micro-batch is compared with the copy's records in its range of SCNs,
    which the files' statistics narrow down, and has a folder of its own, so that
    doing it again changes nothing.
    """

    def add(batch: DataFrame, epoch: int) -> None:
        part = f"{query_id(batch)}-{epoch}"
        batch.persist()
        try:
            low, high = batch.agg(F.min("scn"), F.max("scn")).first()
            rows, seen = dedupe(batch), _copied(batch, copy, part)
            if seen is not None and low is not None:
                seen = seen.where(F.col("scn").between(low, high)).select(*[F.col(c).alias(f"_{c}") for c in CHANGE_COLUMNS])
                same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in CHANGE_COLUMNS]
                rows = rows.join(seen, reduce(Column.__and__, same), "left_anti")
            rows.write.mode("overwrite").parquet(f"{copy.rstrip('/')}/part={part}")
        finally:
            batch.unpersist()

    writer = log.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()
