"""Changes from two versions of a table, where no ops were recorded."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Rows that are new, changed in any of `cols`, or gone, with their `event_type`.

    `keys` are unique and not NULL in both versions. `cols` are those of the new
    version, and of the old one for rows that are gone.
    """
    side = F.struct(*cols)
    before = old.select(*keys, side.alias("_old"))
    after = new.select(*keys, side.alias("_new"))
    both = before.join(after, keys, "full_outer")
    changed = reduce(Column.__or__, [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in cols])
    event = (
        F.when(F.col("_old").isNull(), "I").when(F.col("_new").isNull(), "D").when(changed, "U")
    )
    marked = both.withColumn("event_type", event).where(F.col("event_type").isNotNull())
    values = [F.coalesce("_new", "_old")[c].alias(c) for c in cols]
    return marked.select(*keys, "event_type", *values)
