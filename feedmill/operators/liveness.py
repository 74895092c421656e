"""Was the row there before the op, and what does that make of the op?"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.events import event_code
from feedmill.operators.filters import found_deletes
from feedmill.operators.spread import (
    BUCKET,
    OrderLayout,
    hot_keys,
    key_partitions,
    order_layout,
    previous_value,
)

KEY = ["idx_name", "pk"]

# Ops of this kind are no ops: they say that a row was there before the first
# op. They come from `initial_keys` and from the state of a stream.
MARK = "MARK"
MARK_SEQ = -(2**63)

# Hash of the key. Listed first among the sort columns it settles most
# comparisons, which the names, often alike in their first letters, do not.
_HASH = "_hash"

# A key with more ops than this is split over several tasks.
HOT_ROWS = 4_000_000


def has_flags(df: DataFrame) -> bool:
    return {"created", "found"}.issubset(df.columns)


def live_marks(ops: DataFrame, live_keys: DataFrame) -> DataFrame:
    """`ops` with one MARK row ahead of them per live key."""
    marks = live_keys.select(*KEY, F.lit(MARK).alias("op"), F.lit(MARK_SEQ).alias("seq"))
    return ops.unionByName(marks, allowMissingColumns=True)


def _hot_bucket(df: DataFrame, layout: OrderLayout, hot_rows: int | None) -> tuple[DataFrame, bool]:
    """Add the bucket that splits hot keys; it stays NULL for all others."""
    hot = hot_keys(df, _HASH, HOT_ROWS if hot_rows is None else hot_rows, layout.rows)
    if not hot:
        return df, False
    placed = layout.add_to(df)
    bucket = F.when(F.col("op") == MARK, -1).otherwise(F.col(BUCKET))
    return placed.withColumn(BUCKET, F.when(F.col(_HASH).isin(hot), bucket)), True


def with_liveness(
    applied: DataFrame,
    initial_keys: DataFrame | None = None,
    layout: OrderLayout | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add `created` and `found` to the applied ops.

    If the source supplies both they are kept and nothing is shuffled. Otherwise
    a row is there when the op before on its key was no delete. `initial_keys`
    are the keys that existed before the first op. Keys with more than
    `hot_rows` rows are split by `seq`; finding them costs a look at the keys,
    and only where the table is longer than that at all.
    """
    if has_flags(applied):
        return applied
    rows = applied if initial_keys is None else live_marks(applied, initial_keys)
    layout = layout or order_layout(applied)
    placed, split = _hot_bucket(rows.withColumn(_HASH, F.xxhash64(*KEY)), layout, hot_rows)
    key = [_HASH, *KEY]
    live_after = F.col("op") != "DELETE"
    bucket, partitions = BUCKET if split else None, key_partitions(applied.sparkSession, layout.rows)
    traced = previous_value(placed, key, "seq", live_after, "_before", bucket, partitions)
    was_live = F.coalesce("_before", F.lit(False))
    return (
        traced.where(F.col("op") != MARK)
        .withColumn("created", (F.col("op") == "INDEX") & ~was_live)
        .withColumn("found", (F.col("op") == "DELETE") & was_live)
        .drop("_before", _HASH, BUCKET)
    )


def event_type() -> Column:
    name = F.when(F.col("op") == "DELETE", "DELETE").when(F.col("created"), "INSERT").otherwise("UPDATE")
    return event_code(name)


def found_event_type() -> Column:
    """`event_type`, NULL for deletes that met no row."""
    return F.when((F.col("op") != "DELETE") | F.col("found"), event_type())


def classify(live: DataFrame) -> DataFrame:
    """Add `event_type`; deletes that met no row are left out."""
    return found_deletes(live).withColumn("event_type", event_type())
