"""Ordered work in many tasks.

A window without partitions, or with one big partition, runs in one task. The
helpers here cut the order column into buckets of bounded size, work within
the buckets, and bring what one bucket owes the next as one small row each.
"""

from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET = "_bucket"
#: The task that works on a bucket and its neighbours.
PART = "_part"

# Rows one task should take at most, and the least worth a task of its own.
TASK_ROWS = 250_000
MIN_TASK_ROWS = 16_384
# Narrow rows per partition where rows are brought together by key.
KEY_TASK_ROWS = 4_000_000
# Bound of every per-bucket table.
MAX_BUCKETS = 100_000
# Bound of the list of hot keys, and the entries its sketch keeps per group.
MAX_HOT_KEYS = 4_096
SKETCH_ITEMS = 16_384
SKETCH_GROUPS = 512


@dataclass(frozen=True)
class OrderLayout:
    """Buckets of a unique integer order column, 0 to `n_buckets - 1` in its order.

    Neighbouring buckets share a task where there are more of them than `most_parts`.
    """

    order_col: str
    rows: int
    low: int
    high: int
    width: int
    n_buckets: int
    splits: tuple[float, ...] = field(default=(), repr=False)
    most_parts: int = MAX_BUCKETS

    @property
    def n_parts(self) -> int:
        return min(self.n_buckets, self.most_parts)

    def part(self) -> Column:
        """The task of a bucket; tasks are in the order of their buckets."""
        return F.expr(f"cast({BUCKET} * {self.n_parts}L div {self.n_buckets}L as int)")

    def add_to(self, df: DataFrame, out: str = BUCKET) -> DataFrame:
        value = F.col(self.order_col)
        if not self.splits:
            bucket = F.expr(f"(`{self.order_col}` - {self.low}L) div {self.width}L")
            return df.withColumn(out, bucket.cast("int"))
        raw = f"{out}_raw"
        cut = Bucketizer(splits=list(self.splits), inputCol=raw, outputCol=out)
        placed = cut.transform(df.withColumn(raw, value.cast("double")))
        return placed.withColumn(out, F.col(out).cast("int")).drop(raw)


def order_layout(df: DataFrame, order_col: str = "seq", task_rows: int | None = None) -> OrderLayout:
    """Choose buckets for `order_col`, whose values must be unique.

    Reads that one column. Equal widths are used while they alone bound the
    rows of a bucket; for sparse values such as clock-based ids the cuts are
    quantiles.
    """
    spark = df.sparkSession
    value = F.col(order_col)
    low, high, rows = df.agg(F.min(value), F.max(value), F.count(value)).first()
    if not rows:
        return OrderLayout(order_col, 0, 0, -1, 1, 1)
    fair = max(MIN_TASK_ROWS, min(TASK_ROWS, -(-rows // spark.sparkContext.defaultParallelism)))
    # Equal widths may give four times as many buckets as that.
    parts = -(-4 * rows // fair)
    if task_rows is None:
        task_rows = fair
    task_rows = max(task_rows, -(-rows // MAX_BUCKETS))
    buckets = -(-rows // task_rows)
    span = high - low + 1
    if span <= 4 * rows:
        width = max(task_rows, -(-span // MAX_BUCKETS))
        return OrderLayout(order_col, rows, low, high, width, -(-span // width), most_parts=parts)
    if buckets == 1:
        return OrderLayout(order_col, rows, low, high, span, 1)
    shares = [i / buckets for i in range(1, buckets)]
    inner = df.approxQuantile(order_col, shares, 1 / (4 * buckets))
    splits = (float("-inf"), *sorted(set(inner)), float("inf"))
    return OrderLayout(order_col, rows, low, high, 0, len(splits) - 1, splits, parts)


def hot_keys(df: DataFrame, key_hash: str, hot_rows: int, rows: int) -> list[int]:
    """Hashes of the keys with more than `hot_rows` rows, found with a sketch.

    The list decides only how work is divided, never a result. It is bounded by
    MAX_HOT_KEYS; the sketches are merged in groups so that no task meets one
    per input split.
    """
    if rows <= hot_rows:
        return []
    found = (
        df.select(F.col(key_hash).alias("h"))
        .groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("g"))
        .agg(F.expr(f"approx_top_k_accumulate(h, {SKETCH_ITEMS})").alias("s"))
        # Grouped by one value rather than none: the combining function cannot
        # stand a partition without rows.
        .groupBy(F.expr(f"g div {SKETCH_GROUPS}"))
        .agg(F.expr(f"approx_top_k_combine(s, {SKETCH_ITEMS})").alias("s"))
        .select(F.explode(F.expr(f"approx_top_k_estimate(s, {MAX_HOT_KEYS})")).alias("e"))
        .where(F.col("e.count") > hot_rows)
        .select("e.item")
    )
    return [row.item for row in found.collect()]


def key_partitions(spark: SparkSession, rows: int) -> int | None:
    """How many partitions a shuffle by key needs, where the session's number is too low."""
    needed = -(-rows // KEY_TASK_ROWS)
    return needed if needed > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def previous_value(
    df: DataFrame,
    keys: list[str],
    order_col: str,
    value: Column,
    out: str,
    bucket: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """`value` of the row before, per key, in the order of `order_col`.

    With `bucket`, a key's rows may be spread over many buckets: the last value
    of each bucket is worked out with map-side aggregation, moved on to the
    key's next bucket, and used for the first row there. Rows whose bucket is
    NULL stay together. `value`, the order and the keys are never NULL, and
    `value` is best a number or boolean, which hash aggregation can hold. The
    join follows the partitioning of the window, so the rows are shuffled once.
    """
    together = keys if bucket is None else [*keys, bucket]
    within = W.partitionBy(*together).orderBy(order_col)
    placed = df if partitions is None else df.repartition(partitions, *together)
    if bucket is None:
        return placed.withColumn(out, F.lag(value).over(within))

    spread = placed.withColumn("_near", F.lag(value).over(within))
    across = W.partitionBy(*keys).orderBy(bucket) if keys else W.orderBy(bucket)
    carried = (
        df.where(F.col(bucket).isNotNull())
        .groupBy(*keys, bucket)
        .agg(F.max_by(value, order_col).alias("_last"))
        .withColumn("_far", F.lag("_last").over(across))
        .where(F.col("_far").isNotNull())
        .drop("_last")
    )
    joined = spread.join(carried, together, "left")
    return joined.select(*df.columns, F.coalesce("_near", "_far").alias(out))
