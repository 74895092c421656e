import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedmill.llm import mixing, quality_rules, sharding
from feedmill.llm.common import numbered
from feedmill.llm.components import components
from feedmill.llm.queries import ORACLE, QUERIES
from tests.llm.helpers import ODD, docs_table, prose, words


def test_one_cycle_is_proportionate():
    for weights in ({"a": 1.0}, {"a": 0.5, "b": 0.3, "c": 0.2}, {str(i): 1.0 + i % 7 for i in range(50)}):
        share = mixing.shares(weights, 128)
        assert sum(share.values()) == 128 and min(share.values()) >= 1
        slots = mixing.one_cycle(share)
        seen = Counter()
        for t, (source, number, slot) in enumerate(slots, 1):
            assert slot == t - 1 and number == seen[source]
            seen[source] += 1
            assert all(abs(seen[s] - share[s] * t / 128) < 1 for s in share)


def check_mix(rows, sizes, block):
    assert {r.doc_id for r in rows} == set(range(sum(sizes.values())))
    slots = defaultdict(list)
    for r in rows:
        slots[r.mix_slot].append(r)
    assert sorted(slots) == list(range(len(slots)))
    for part in slots.values():
        assert len({(r.mix_class, r.mix_block) for r in part}) == 1 and len(part) <= block
        assert len({r.mix_rank for r in part}) == len(part)


@pytest.mark.parametrize("weights", [None, {"hot": 0.5, "small": 0.25, "mid": 0.25}, {"hot": 0.3, "small": 0.7}])
def test_mix_uses_every_document(spark, weights):
    sizes = {"hot": 300, "mid": 50, "small": 7}
    names = [s for s, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame([(i, s, "x") for i, s in enumerate(names)], "doc_id long, source string, mix_slot string")
    rows = mixing.mix(df, weights, block_docs=5).collect()
    check_mix(rows, sizes, 5)
    if weights and "mid" in weights:
        blocks = Counter(c for c, _ in {(r.mix_class, r.mix_slot) for r in rows})
        total = sum(blocks.values())
        assert all(abs(blocks[s] - w * total) <= 1 + 0.001 * total for s, w in weights.items())
    assert len({(r.doc_id, r.mix_epoch) for r in rows}) == len(rows)


def test_mix_of_columns_with_its_own_names(spark):
    """They come out as they went in; only the added columns replace others."""
    names = ["p_class", "c_slot", "p_share", "__block", "__number", "__row", "__key", "__bucket", "s", "n"]
    rows = [(i, "ab"[i % 2], *[f"{name}{i}" for name in names]) for i in range(30)]
    df = spark.createDataFrame(rows, ["doc_id", "source", *names])
    found = mixing.mix(df, block_docs=4)
    assert found.columns == ["doc_id", "source", *names, *mixing.ADDED]
    kept = found.where("mix_epoch = 0").select(*df.columns)
    assert sorted(map(tuple, kept.collect())) == sorted(rows)
    assert sorted(map(tuple, mixing.mixed_rows(df).distinct().collect())) == sorted(rows)


def test_mix_of_odd_tables(spark):
    df = docs_table(spark, ODD)
    assert mixing.mix(df.limit(0)).count() == 0
    found = mixing.mixed_rows(df)
    assert found.columns == df.columns and {r.doc_id for r in found.collect()} == set(range(len(ODD)))
    assert Counter(r.mix_class for r in mixing.mix(df).collect())[mixing.MISSING] >= 2


def test_shards_move_only_into_the_new_one(spark):
    texts = [*ODD, *[f"t{i}" for i in range(1500)]]
    rows = sharding.shard(docs_table(spark, texts)).collect()
    slots = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(40))
    assert 10 <= sum(r.grown_shard == 40 for r in rows) <= 80


def test_a_changed_weight_moves_rows_in_its_subtrees_only(spark):
    before = sharding.tree(16)
    after = [(r, k, s, 3.0 if s == 5 else w) for r, k, s, w in before]
    df = spark.range(4000).select(F.col("id"), sharding.place(F.col("id"), before).alias("a"), sharding.place(F.col("id"), after).alias("b"))
    for r in df.where("a != b").collect():
        same_region = r.a // 8 == r.b // 8
        assert r.b // 8 == 0 and (not same_region or r.b // 4 == 1 or r.a // 4 == 1)
    odd = df.sparkSession.createDataFrame([(None,), ("",)], "k string").select(sharding.place(F.col("k"), before).alias("s")).collect()
    assert odd[0].s == odd[1].s
    assert sharding.shard(docs_table(spark, ODD).limit(0)).count() == 0


def test_numbers_have_no_gaps(spark, monkeypatch):
    monkeypatch.setattr("feedmill.llm.common.BUCKET_ROWS", 7)
    df = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, F.lit("k")).alias("key"))
    rows = numbered(df, ["key"], [F.col("id")], "n", [F.col("id")], 500).collect()
    for key in ("k", None):
        assert sorted(r.n for r in rows if r.key == key) == list(range(sum(r.key == key for r in rows)))


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = {r.v: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 140), 100)}


def plain_counts(text):
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if grams[g] > 1 for k in range(3)}
    lines, twice = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            twice += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), twice, len(covered)


def test_counts_of_texts():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", " ", "\n", "é ", "#", "\t", "|x", "\x0b"]) for _ in range(rng.randint(0, 80)))
        assert quality_rules.statistics(text.encode())[:5] == plain_counts(text)


def test_rules_reject_outliers_and_keep_the_rest(spark):
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(60, 200), 900) for _ in range(300)]
    junk = [" ".join(f"{w}$$$" for w in prose(rng, 90, 900).split()) for _ in range(12)]
    repeats = ["again and again " * 30] * 3
    rows = {r.doc_id: r for r in quality_rules.quality_rules(docs_table(spark, [*texts, *junk, *repeats, *ODD])).collect()}
    assert all(rows[i].kept for i in range(300))
    assert not any(rows[i].kept for i in range(300, 315)) and not any(rows[i].base_failed for i in range(300, 312))
    for i, text in enumerate([*texts, *junk, *repeats, *ODD]):
        r = rows[i]
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == plain_counts(text)
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])


def test_estimate_is_that_of_the_concentrated_half():
    """One step over bins against sorting all rows."""
    rng = np.random.default_rng(5)
    data = rng.normal(0, 1, (400, 5)) * [1, 2, 0.5, 1, 1]
    far = (data**2).sum(axis=1)
    bins = np.floor(np.log2(far + 1e-6) * quality_rules.BINS_PER_OCTAVE).astype(int)
    frame = pd.DataFrame({"lang": "en", "source": "s", "bin": bins, "n": 1})
    for i in range(5):
        frame[f"s{i}"] = data[:, i]
        for j in range(i + 1):
            frame[f"c{i}{j}"] = data[:, i] * data[:, j]
    sums = frame.groupby(["lang", "source", "bin"], as_index=False).sum()
    row = quality_rules._estimate(0.5)(sums).iloc[0]
    half = data[np.argsort(far)[:201]]
    cov = np.cov(half.T, bias=True) + np.diag(np.square(quality_rules.FLOOR))
    assert np.allclose(row["mean"], half.mean(axis=0), atol=0.05)
    assert np.allclose(np.linalg.inv(np.array(row["inverse"]).reshape(5, 5)), cov, atol=0.1)


def test_a_third_of_identical_outliers_goes(spark):
    """A hot third of copies of junk doesn't become the group's centre, nor hide other outliers."""
    rng = random.Random(9)
    texts = [prose(rng, rng.randint(60, 200), 900) for _ in range(200)]
    junk = " ".join(f"{w}$$$" for w in prose(rng, 90, 900).split())
    other = " ".join(w.upper() * 9 for w in prose(rng, 90, 900).split())
    rows = [(i, t, "en", "s") for i, t in enumerate([*texts, *[junk] * 100, other])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality_rules.quality_rules(df).where("kept").collect()}
    assert kept == set(range(200))


def test_scatter_of_the_half_is_made_consistent():
    assert quality_rules._chi_square(11.0705, 5) == pytest.approx(0.95, abs=1e-5)
    data = np.random.default_rng(1).normal(0, 1, (200_000, 5))
    half = data[np.argsort((data**2).sum(axis=1))[:100_003]]
    assert np.allclose(np.cov(half.T) * quality_rules.consistency(100_003 / 200_000, 5), np.eye(5), atol=0.02)


def test_rules_of_odd_tables(spark):
    df = docs_table(spark, ODD)
    assert quality_rules.quality_rules(df.limit(0)).count() == 0
    assert not any(r.kept for r in quality_rules.quality_rules(df.union(df)).collect())
    assert quality_rules.drop_outliers(df).count() == 0


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == columns
    rows = docs.collect()
    assert rows and all(before[r.doc_id] == r.text for r in rows)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert Counter(r.doc_id for r in last) == Counter(r.doc_id for r in rows)
    assert all(r.decoded == before[r.doc_id] for r in last)
    assert len({" ".join(words(r.text)) for r in rows}) == len({r.doc_id for r in rows})


def test_queries_and_sql(spark, sf_dir):
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 11))
    assert ORACLE.keys() <= QUERIES.keys()
