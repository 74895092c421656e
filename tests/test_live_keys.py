"""The log-structured table of live keys against a set, and what it costs."""

import random

import pytest
from pyspark.sql import functions as F

from feedmill.streaming import liveness
from feedmill.streaming.liveness import LiveKeys
from tests.helpers import ops_table


def batches(seed, n_batches, n_ops, keys):
    rng = random.Random(seed)
    seq = 0
    for _ in range(n_batches):
        rows = []
        for _ in range(rng.randrange(n_ops)):
            rows.append({"seq": seq, "pk": str(rng.randrange(keys)), "idx_name": rng.choice("ab"), "op": rng.choice(["INDEX", "DELETE"])})
            seq += 1
        yield rows


def apply(live, rows):
    for r in rows:
        key = (r["idx_name"], r["pk"])
        (live.discard if r["op"] == "DELETE" else live.add)(key)


@pytest.fixture
def small(monkeypatch):
    """Everything that needs many rows happens with few."""
    for name, value in (("BUCKET_ROWS", 8), ("FAN", 3), ("LEAST_ROWS", 4)):
        monkeypatch.setattr(liveness, name, value)


@pytest.mark.parametrize("with_initial", [False, True])
def test_same_as_a_set(spark, tmp_path, small, with_initial):
    live = {("a", str(i)) for i in range(20)} if with_initial else set()
    initial = spark.createDataFrame([(*k,) for k in sorted(live)] * 2, "idx_name string, pk string") if live else None
    keys = LiveKeys(str(tmp_path), initial)
    kinds = set()
    for epoch, rows in enumerate(batches(int(with_initial), 6 if with_initial else 12, 14, 40)):
        batch = ops_table(spark, rows)
        touched = {(r["idx_name"], r["pk"]) for r in rows}
        for again in range(2 if epoch % 3 == 2 else 1):  # a batch done again gives the same table
            reader = LiveKeys(str(tmp_path), initial) if again else keys
            assert {tuple(r) for r in reader.before(batch, epoch).collect()} == live & touched
            reader.store(batch, epoch)
            keys = reader
        apply(live, rows)
        assert {tuple(r) for r in keys.after(spark, epoch).collect()} == live
        manifest = keys.manifest(spark, epoch)
        kinds |= {f"level {d[1]}" for d in manifest.deltas} | ({"split"} if manifest.n_buckets > (3 if with_initial else 1) else set())
        kinds |= {"base"} if any(e >= 0 for e, _ in manifest.base.values()) else set()
    assert kinds >= ({"level 0", "base"} if with_initial else {"level 0", "level 1", "base", "split"})


def test_dead_keys_do_not_come_back(spark, tmp_path, small, monkeypatch):
    """A bucket gets a new base while an old delta, which names its keys, stays for other buckets."""
    keys = LiveKeys(str(tmp_path), spark.range(60).select(F.lit("a").alias("idx_name"), F.col("id").cast("string").alias("pk")))
    n = keys.manifest(spark, -1).n_buckets
    place = {r.pk: r.b for r in spark.range(200).select(F.col("id").cast("string").alias("pk")).select("pk", F.pmod(F.xxhash64(F.lit("a"), "pk"), F.lit(n)).alias("b")).collect()}
    one, two = ([k for k, b in place.items() if b == bucket and int(k) >= 60] for bucket in (0, 1))
    keys.store(ops_table(spark, [{"seq": 0, "idx_name": "a", "pk": one[0]}, {"seq": 1, "idx_name": "a", "pk": two[0]}]), 0)
    keys.store(ops_table(spark, [{"seq": 2, "idx_name": "a", "pk": one[0], "op": "DELETE"}]), 1)
    keys.store(ops_table(spark, [{"seq": 10 + i, "idx_name": "a", "pk": k} for i, k in enumerate(one[1:7])]), 2)
    manifest = keys.manifest(spark, 2)
    assert manifest.base[0][0] == 2 and manifest.deltas and manifest.base[1][0] == -1
    keys.store(ops_table(spark, [{"seq": 20, "idx_name": "a", "pk": two[1]}]), 3)
    live = {r.pk for r in keys.after(spark, 3).collect()}
    assert live == {str(i) for i in range(60)} | set(one[1:7]) | set(two[:2])
    assert keys.before(ops_table(spark, [{"idx_name": "a", "pk": one[0]}]), 4).isEmpty()


def test_files_that_no_batch_needs_go(spark, tmp_path, small):
    keys = LiveKeys(str(tmp_path))
    for epoch, rows in enumerate(batches(5, 9, 14, 30)):
        keys.store(ops_table(spark, rows), epoch)
    named = {f"{keys._folder}/{p}" for e in (6, 7, 8) for p in keys.manifest(spark, e).paths()}
    there = {str(p.parent) for p in (tmp_path / "live_keys").rglob("*.parquet")}
    assert there <= named and len(list((tmp_path / "live_keys" / "manifest").glob("0*.json"))) == 3


def test_a_batch_rewrites_little(spark, tmp_path):
    """1,000,000 live keys, batches of 1,000: less than 5 % of the table is written, merges included."""
    initial = spark.range(1_000_000).select(F.lit("a").alias("idx_name"), F.col("id").cast("string").alias("pk"))
    keys = LiveKeys(str(tmp_path), initial)
    written = []
    for epoch in range(9):
        batch = spark.range(1000).selectExpr(
            f"id + {epoch} * 1000 as seq", "'a' as idx_name", f"cast((id * 7919 + {epoch}) % 1100000 as string) as pk",
            "if(id % 5 = 0, 'DELETE', 'INDEX') as op",
        )
        assert keys.before(batch, epoch).count() > 800
        keys.store(batch, epoch)
        written.append(keys.manifest(spark, epoch).written)
    assert max(written) <= 50_000 and sum(written) / 9 <= 3_000
    gone = 1_000_000 - keys.after(spark, 8).count()
    assert 0 < gone < 9 * 200
