"""Change numbers (SCN): dense numbering, block reservation, per-writer blocks."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedmill.operators.spread import BUCKET, PART, OrderLayout, order_layout
from feedmill.schemas import SCN_STEP


def bucket_counts(df: DataFrame, layout: OrderLayout) -> DataFrame:
    """Rows per bucket; never more than MAX_BUCKETS rows plus one."""
    return layout.add_to(df).groupBy(BUCKET).agg(F.count("*").alias("_n"))


def _place(df: DataFrame, layout: OrderLayout) -> DataFrame:
    """Each bucket in the partition of its own number, or with its neighbours where buckets are many and small."""
    placed = layout.add_to(df).where(F.col(BUCKET).isNotNull()).withColumn(PART, layout.part())
    return placed.repartitionById(layout.n_parts, PART)


def _label_counts(labels: DataFrame, layout: OrderLayout) -> DataFrame:
    """`bucket_counts` taken behind the exchange of the labels.

    The tests that are always true ask for all columns of the labels, so that
    this and the numbering ask for the same exchange and Spark runs it once.
    """
    any_key = F.col("_key") >= F.lit(-(2**63))
    present = F.col("event_type").isNotNull() & (F.col("seq") >= layout.low) & any_key
    return _place(labels, layout).groupBy(PART, BUCKET).agg(F.count_if(present).alias("_n")).drop(PART)


def _offsets(counts: DataFrame) -> DataFrame:
    before = W.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    return counts.select(BUCKET, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))


def _twice(order_col: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{order_col} is not unique: "), F.col(order_col).cast("string")))


def _key_hash() -> Column:
    return F.xxhash64("idx_name", "pk").alias("_key")


def _numbered(
    df: DataFrame, order_col: str, start: int, layout: OrderLayout, counts: DataFrame | None
) -> DataFrame:
    placed = _place(df, layout)
    within = W.partitionBy(PART, BUCKET).orderBy(order_col)
    offsets = _offsets(bucket_counts(df, layout) if counts is None else counts)
    numbered = placed.withColumns(
        {"_rn": F.row_number().over(within), "_twin": F.lag(order_col).over(within)}
    ).join(F.broadcast(offsets), BUCKET)
    scn = F.col("_offset") + F.col("_rn") + F.lit(start)
    first = F.when(F.col("_twin") == F.col(order_col), _twice(order_col)).otherwise(scn)
    return numbered.withColumn("scn", first.cast("long"))


def assign_scn(
    df: DataFrame,
    start: int = 0,
    order_col: str = "seq",
    layout: OrderLayout | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Number the rows `start + 1`, `start + 2`, ... in the order of `order_col`.

    A value of `order_col` that comes twice fails the job.
    Each bucket goes to a partition with its neighbours and is numbered there;
    the rows before it come from the counts, which are broadcast since there is
    one per bucket. The result is range-partitioned by `scn` and sorted, so
    files written from it can be skipped by their smallest and largest `scn`.
    """
    layout = layout or order_layout(df, order_col)
    return _numbered(df, order_col, start, layout, counts).select("scn", *df.columns)


def number_labelled(
    payload: DataFrame,
    labels: DataFrame,
    start: int,
    layout: OrderLayout,
    counts: DataFrame | None = None,
) -> DataFrame:
    """`assign_scn` for rows whose labels were worked out apart from them.

    `labels` (`seq`, `idx_name`, `pk`, `event_type`) has every row of `payload`;
    those with an event type are numbered. A `seq` that comes twice among all of
    them fails the job, and rows meet on `seq` and key, so that none can get the
    label of another. Both go to the partition of their bucket and are merged
    there: the wide rows are shuffled this one time and no window buffers them.
    """
    known = labels.where(F.col("seq").isNotNull()).select("seq", "event_type", _key_hash())
    counts = _label_counts(known, layout) if counts is None else counts
    within = W.partitionBy(PART, BUCKET).orderBy("seq")
    labelled = F.col("event_type").isNotNull()
    traced = _place(known, layout).withColumns(
        {
            "_rn": F.count_if(labelled).over(within.rowsBetween(W.unboundedPreceding, 0)),
            "_twin": F.max("seq").over(within.rowsBetween(W.unboundedPreceding, -1)),
        }
    )
    kept = traced.where(F.when(F.col("_twin") == F.col("seq"), _twice("seq").cast("boolean")).otherwise(labelled))
    scn = F.col("_offset") + F.col("_rn") + F.lit(start)
    heads = kept.join(F.broadcast(_offsets(counts)), BUCKET).withColumn("scn", scn.cast("long"))
    bodies = _place(payload.withColumn("_key", _key_hash()), layout)
    joined = bodies.join(heads.select(PART, BUCKET, "seq", "_key", "event_type", "scn").hint("merge"), [PART, BUCKET, "seq", "_key"])
    return joined.select("scn", "event_type", *payload.columns)


def next_hwm(hwm: int | Column, n: int | Column, step: int | Column = SCN_STEP) -> int | Column:
    """The mark after one writer starts at `hwm` and uses `n` numbers.

    One block is reserved at the start, another whenever one is used up.
    """
    if any(isinstance(v, Column) for v in (hwm, n, step)):
        hwm, n, step = (v if isinstance(v, Column) else F.lit(v) for v in (hwm, n, step))
        blocks = F.call_function("div", n + step - 1, step)
        return (hwm + step * F.greatest(F.lit(1), blocks)).cast("long")
    return hwm + step * max(1, -(-n // step))


def continued_hwm(hwm: int, last: int, n: int, step: int = SCN_STEP) -> int:
    """The mark after a writer that has used numbers up to `last` uses `n` more."""
    return hwm + step * max(0, -(-(last + n - hwm) // step))


def assign_scn_blocks(
    df: DataFrame,
    writer_col: str,
    hwm: int = 0,
    step: int = SCN_STEP,
    order_col: str = "seq",
    layout: OrderLayout | None = None,
) -> DataFrame:
    """Number the rows with blocks of `step` that each writer reserves for itself.

    Writers take their blocks in the order of their names, each as many as its
    rows need. A writer's rows are spread over the buckets of `order_col`, so
    one writer may have most of them.
    """
    layout = layout or order_layout(df, order_col)
    placed = layout.add_to(df)
    counts = placed.groupBy(writer_col, BUCKET).agg(F.count("*").alias("_n"))
    earlier = W.partitionBy(writer_col).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    blocks = counts.groupBy(writer_col).agg(F.expr(f"(sum(_n) + {step - 1}) div {step}").alias("_blocks"))
    ahead = W.orderBy(writer_col).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(
        writer_col, F.coalesce(F.sum("_blocks").over(ahead), F.lit(0)).alias("_first")
    )
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    starts = starts.drop("_n").join(blocks, writer_col)

    within = W.partitionBy(writer_col, BUCKET).orderBy(order_col)
    numbered = placed.withColumn("_rn", F.row_number().over(within))
    joined = numbered.join(starts, [writer_col, BUCKET])
    scn = F.expr(
        f"{hwm}L + (_first + (_before + _rn - 1) div {step}) * {step}L + (_before + _rn - 1) % {step} + 1"
    )
    return joined.select(scn.cast("long").alias("scn"), *df.columns)
