"""Volume of a stream of change records: counts per table and time window while it runs.

Each micro-batch adds its counts as a table of its own, so the sums lose nothing,
however late a record is, and a batch done again changes nothing. A watermark
trails the latest capture time of the batches before; records of a window that it
had passed are counted, and told apart as late. Counts of single batches come from
the same pass, by `observe`.
"""

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedmill.functions.events import stamp_time
from feedmill.operators.consume import COUNTS, event_counts
from feedmill.sources import files
from feedmill.tables import empty_table

VOLUME_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("idx_name", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in [*COUNTS, "n_late"]],
    ]
)
# One row per micro-batch. `upto` is the latest capture time so far, `watermark` that of the batch's own start.
BATCH_SCHEMA = T.StructType(
    [
        T.StructField("epoch", T.LongType()),
        *[T.StructField(c, T.LongType()) for c in [*COUNTS, "n_late", "n_untimed"]],
        T.StructField("upto", T.StringType()),
        T.StructField("watermark", T.StringType()),
    ]
)


def _batch_file(path: str, epoch: int) -> str:
    return f"{path.rstrip('/')}/batches/{epoch:012d}.json"


def _count_batch(batch: DataFrame, epoch: int, path: str, width: str, delay: str) -> None:
    spark = batch.sparkSession
    before = json.loads(files.read_text(spark, _batch_file(path, epoch - 1)) or "{}") if epoch else {}
    upto = before.get("upto")
    watermark = F.lit(upto).cast("timestamp_ntz") - F.expr(f"interval {delay}")
    timed = batch.select("idx_name", "event_type", stamp_time(F.col("create_time")).alias("_at"))
    seen, late = Observation(), Observation()
    timed = timed.observe(
        seen, *event_counts(), F.count_if(F.col("_at").isNull()).alias("n_untimed"), F.max("_at").cast("string").alias("upto")
    )
    # Records without a time are a group that is not written: what is observed has to outlive the grouping.
    at = F.coalesce("_at", F.lit("1970-01-01").cast("timestamp_ntz"))
    counted = timed.groupBy(F.window(at, width), "idx_name", F.col("_at").isNull().alias("_untimed")).agg(*event_counts())
    # A window ends after its last instant, so one whose end the watermark has reached is closed.
    closed = F.coalesce(~F.col("_untimed") & (F.col("window.end") <= watermark), F.lit(False))
    counted = counted.withColumns(
        {"n_late": F.when(closed, F.col("n")).otherwise(0).cast("long"), "_watermark": watermark.cast("string")}
    ).observe(late, F.coalesce(F.sum("n_late"), F.lit(0)).alias("n_late"), F.max("_watermark").alias("watermark"))
    rows = counted.where(~F.col("_untimed")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "idx_name", *COUNTS, "n_late"
    )
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/counts/epoch={epoch}")
    # Nothing is observed of no rows.
    nothing = batch.isEmpty()
    found = dict.fromkeys([*COUNTS, "n_late", "n_untimed"], 0) | {"upto": None, "watermark": None} if nothing else {**seen.get, **late.get}
    found["upto"] = max((t for t in (upto, found["upto"]) if t is not None), default=None)
    files.write_text(spark, _batch_file(path, epoch), json.dumps({"epoch": epoch, **found}) + "\n")


def stream_volume(
    log: DataFrame, path: str, checkpoint: str, width: str = "1 hour", delay: str = "1 hour", **trigger
) -> StreamingQuery:
    """Keep counts of a stream of change records (`stream_log`) at `path`.

    A window is closed once the latest capture time of earlier micro-batches is
    `delay` past its end. Records without a capture time are in no window; they
    are counted per batch (`n_untimed`).
    """

    def add(batch: DataFrame, epoch: int) -> None:
        _count_batch(batch, epoch, path, width, delay)

    writer = log.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def read_volume(spark: SparkSession, path: str) -> DataFrame:
    """Counts per window and table so far; `n_late` of the `n` records came when the window was closed."""
    try:
        parts = spark.read.schema(VOLUME_SCHEMA).parquet(f"{path.rstrip('/')}/counts")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        parts = empty_table(spark, VOLUME_SCHEMA)
    sums = [F.sum(c).alias(c) for c in [*COUNTS, "n_late"]]
    return parts.groupBy("window_start", "window_end", "idx_name").agg(*sums)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Counts of each micro-batch, with its watermark and the latest capture time so far."""
    try:
        return spark.read.schema(BATCH_SCHEMA).json(f"{path.rstrip('/')}/batches")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, BATCH_SCHEMA)
