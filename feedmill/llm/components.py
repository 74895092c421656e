"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(v, label) for every end of a link (a, b); label is the smallest end that links lead to.

    Each round takes the smallest label among neighbours and then that label's
    own label, so long chains shorten quickly. Rounds are written tables; only
    whether anything changed reaches the driver.
    """
    both = written(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = written(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnsRenamed({"v": "b", "label": "near"}), "b").groupBy(F.col("a").alias("v")).agg(F.min("near").alias("near"))
        nearer = labels.join(seen, "v").select("v", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("v").alias("next"), F.col("label").alias("far"))
        moved = written(
            nearer.join(jump, "next", "left").select(
                "v", F.least("next", F.coalesce("far", "next")).alias("label"), (F.least("next", F.coalesce("far", "next")) != F.col("label")).alias("changed")
            ),
            "labels",
        )
        labels = moved.select("v", "label")
        if moved.where("changed").isEmpty():
            return labels
