import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedmill.operators.scn import assign_scn, assign_scn_blocks, continued_hwm, next_hwm
from feedmill.operators.spread import MAX_BUCKETS, hot_keys, key_partitions, order_layout, previous_value

STEP = 100_000


@pytest.mark.parametrize(
    "n, hwm",
    [(0, STEP), (1, STEP), (STEP - 1, STEP), (STEP, STEP), (STEP + 1, 2 * STEP), (3 * STEP, 3 * STEP)],
)
def test_next_hwm(spark, n, hwm):
    assert next_hwm(0, n) == hwm
    assert next_hwm(700, n) == 700 + hwm
    got = spark.createDataFrame([(n,)], "n long").select(next_hwm(F.lit(0), F.col("n"))).first()[0]
    assert got == hwm


def test_continued_hwm():
    assert continued_hwm(100, 30, 70, 100) == 100
    assert continued_hwm(100, 30, 71, 100) == 200
    assert continued_hwm(100, 100, 0, 100) == 100
    assert continued_hwm(100, 100, 250, 100) == 400


def values_of(kind, n=500):
    rng = random.Random(kind)
    if kind == "dense":
        return list(range(1000, 1000 + n))
    if kind == "sparse":
        return rng.sample(range(2**62), n)
    if kind == "clustered":
        # A third within one small stretch of a huge range, as clock-based ids have it.
        return [*range(n // 3), *rng.sample(range(2**40, 2**60), n - n // 3)]
    if kind == "negative":
        return list(range(-n, 0))
    return [7]


@pytest.mark.parametrize("kind", ["dense", "sparse", "clustered", "negative", "single"])
def test_scn_follows_the_order(spark, kind):
    values = values_of(kind)
    df = spark.createDataFrame([(v,) for v in random.Random(1).sample(values, len(values))], "seq long")
    layout = order_layout(df, task_rows=20)
    assert layout.n_buckets <= MAX_BUCKETS
    sizes = [r["count"] for r in layout.add_to(df).groupBy("_bucket").count().collect()]
    assert max(sizes) <= 40
    numbered = assign_scn(df, start=10, layout=layout)
    assert [(r.scn, r.seq) for r in numbered.orderBy("scn").collect()] == [
        (11 + i, v) for i, v in enumerate(sorted(values))
    ]


def test_scn_of_nothing(spark):
    empty = spark.range(0).select(F.col("id").alias("seq"))
    assert assign_scn(empty).isEmpty()
    assert assign_scn_blocks(empty.withColumn("w", F.lit("a")), "w").isEmpty()


def test_blocks_of_many_writers(spark):
    rng = random.Random(4)
    rows = [(i, "big" if rng.random() < 0.6 else rng.choice("abc")) for i in range(500)]
    df = spark.createDataFrame(rows, "seq long, writer string")
    layout = order_layout(df, task_rows=20)
    got = {r.seq: r.scn for r in assign_scn_blocks(df, "writer", 1000, 50, layout=layout).collect()}
    expected, first = {}, 1000
    for writer in sorted({w for _, w in rows}):
        mine = [s for s, w in rows if w == writer]
        expected.update({s: first + i + 1 for i, s in enumerate(mine)})
        first += 50 * -(-len(mine) // 50)
    assert got == expected


def test_hot_keys(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("h"))
    assert hot_keys(df, "h", 500, 3000) == [-1]
    assert hot_keys(df, "h", 3000, 3000) == []


def test_previous_value_of_a_spread_key(spark):
    rng = random.Random(5)
    rows = [(s, rng.choice("aab"), s * 7) for s in rng.sample(range(10_000), 400)]
    df = spark.createDataFrame(rows, "seq long, k string, v long")
    layout = order_layout(df, task_rows=30)
    placed = layout.add_to(df)
    last, expected = {}, {}
    for s, k, v in sorted(rows):
        expected[s] = last.get(k)
        last[k] = v
    for bucket in (None, "_bucket"):
        got = previous_value(placed, ["k"], "seq", F.col("v"), "before", bucket)
        assert {r.seq: r.before for r in got.collect()} == expected


def test_an_order_that_is_not_unique_fails(spark):
    twice = spark.createDataFrame([(1,), (2,), (2,)], "seq long")
    with pytest.raises(PySparkException, match="seq is not unique: 2"):
        assign_scn(twice).collect()


def test_partitions_grow_with_the_rows(spark):
    assert key_partitions(spark, 1000) is None
    assert key_partitions(spark, 10**9) == 250
