import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from feedmill.llm import blocks, exact_dedup, golomb, jaccard_join, suffix_dedup
from tests.llm.helpers import ODD, components, docs_table, prose, some_texts


@pytest.mark.parametrize("n", [0, 1, 2, 7, 5000, 70000])
def test_golomb_round_trip(n):
    values = np.unique(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    assert (golomb.decode(golomb.encode(values, 0, 2**64)) == values).all()
    assert n < 5000 or len(golomb.encode(values, 0, 2**64)) < 8 * n


def test_exact_dedup_keeps_the_smallest_id(spark):
    texts = some_texts()
    rows = exact_dedup.exact_dedup(docs_table(spark, texts)).collect()
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for t in texts]
    size = Counter(norm)
    for r in rows:
        t = norm[r.doc_id]
        keep = norm.index(t)
        assert (r.keep_id, r.group_size, r.kept) == (keep, size[t], keep == r.doc_id)
        assert r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert len(rows) == len(texts)


def test_exact_dedup_of_repeated_rows_null_ids_and_empty_tables(spark):
    data = [(1, "a b"), (1, "a  b"), (1, "c"), (None, "a b"), (None, None), (3, ""), (2, "a b")]
    df = spark.createDataFrame([(i, t, True) for i, t in data], "doc_id long, text string, kept boolean")
    rows = exact_dedup.exact_dedup(df).collect()
    assert len(rows) == len(data)
    assert sorted(r.text_sha256 for r in rows if r.kept) == sorted(
        hashlib.sha256(t.encode()).hexdigest() for t in ("a b", "c", "")
    )
    left = exact_dedup.drop_copies(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id, re.sub(" +", " ", r.text)) for r in left.collect()) == [(1, "a b"), (1, "c"), (3, "")]
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def plain_removal(texts, width):
    count = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if count[t[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_and_common_prefixes(seed):
    rng = random.Random(seed)
    for _ in range(40):
        t = bytes(rng.choice(b"\0\0ab" if seed % 2 else b"aaab") for _ in range(rng.randint(1, 80)))
        x = np.frombuffer(t, np.uint8)
        order = suffix_dedup.suffix_array(x)
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        shared = suffix_dedup.common_prefixes(x, order).tolist()
        for k in range(1, len(t)):
            a, b = t[order[k] :], t[order[k - 1] :]
            n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            assert shared[k] == n


@pytest.mark.parametrize(("hot", "block"), [(5000, 1 << 20), (2, 1 << 20), (2, 3000), (10**9, 3000)])
def test_repeats_are_removed(spark, monkeypatch, hot, block):
    monkeypatch.setattr(blocks, "BLOCK", block)
    texts = [*some_texts(3, 50), "ab" * 400, "é" * 150, "z" * 199, "y" * 200, "y" * 201]
    rows = suffix_dedup.remove_repeats(docs_table(spark, texts), hot=hot).collect()
    wanted = plain_removal([(t or "").encode() for t in texts], 200)
    assert {r.doc_id: tuple(r)[1:] for r in rows} == dict(enumerate(wanted))


@pytest.mark.parametrize("n_shards", [1, 7, 1000])
def test_segments_are_dealt_as_one_row_each_whatever_the_shards(n_shards):
    rng = random.Random(8)
    text = " ".join(prose(rng, 60) for _ in range(20)).encode()
    docs = [text, b"and " + text]
    sizes = np.array([len(d) for d in docs], np.int64).tobytes()
    blob = zstandard.ZstdCompressor(level=1).compress(b"".join(docs))
    w = suffix_dedup.Windows(sizes, blob)
    rows = pa.table({"block": pa.array([5], pa.int64()), "sizes": pa.array([sizes]), "blob": pa.array([blob])})
    codes = pa.table({"owner": pa.array([0], pa.int64()), "codes": pa.array([(w.counts > 1).astype(np.uint8).tobytes()])})
    dealt = suffix_dedup._deal(n_shards)(rows, codes)
    starts, lengths, keys = suffix_dedup._segments(w, codes)
    assert dealt.num_rows == len(suffix_dedup._distinct(w.buf, starts, lengths, keys)[0]) > 50
    assert sum(dealt["copies"].to_pylist()) == len(starts)
    held = {(w.buf[a : a + k].tobytes()) for a, k in zip(starts.tolist(), lengths.tolist(), strict=True)}
    assert set(dealt["bytes"].to_pylist()) == held


def test_repeats_of_odd_tables(spark):
    df = docs_table(spark, ODD)
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0
    found = suffix_dedup.remove_repeats(df.union(df), keep_text=True).where("doc_id = 4").collect()
    assert [(r.n_bytes, r.n_removed, bytes(r.kept)) for r in found] == [(3000, 3000, b"")] * 2


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_jaccard_components(spark, width, percent):
    rng = random.Random(9)
    texts = some_texts(5, 40)
    for n in (4, 7, 9, 14, 17, 22, 30, 60):
        base = [f"w{rng.randrange(200)}" for _ in range(n)]
        for _ in range(9):
            t = list(base)
            for _ in range(rng.randint(0, 2)):
                t[rng.choice([0, -1, rng.randrange(n)])] = rng.choice(["New", "old", "x"])
            texts.append(" ".join(t))
    rows = jaccard_join.jaccard_components(docs_table(spark, texts), width=width, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components(texts, width, percent)


def test_jaccard_of_many_different_near_copies(spark):
    """One passage in 160 versions, each with other words changed: long lists, many links, nothing lost."""
    rng = random.Random(9)
    base = prose(rng, 160, 10**6).split()
    texts = []
    for _ in range(160):
        w = list(base)
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(w[: rng.randrange(120, 161)]))
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs_table(spark, texts), width=4, percent=85).collect()}
    assert found == components(texts, 4, 85)


def test_copies_of_a_passage_are_linked_by_the_one_without_changes(spark, monkeypatch):
    """Versions that are like the passage and not like each other: no pairs of versions are left to compare."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(200):
        w = list(base)
        for _ in range(1 + i % 2):
            w[rng.randrange(10, 140)] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    texts.insert(77, " ".join(base))
    tried = []

    def noted(pairs, sets, percent):
        tried.append(pairs.count())
        return verified(pairs, sets, percent)

    verified = jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", noted)
    rows = jaccard_join.jaccard_components(docs_table(spark, texts), width=4, percent=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == components(texts, 4, 85)
    assert len(tried) == 2 and sum(tried) < 3 * len(texts)


def test_boundary_follows_the_costs():
    assert jaccard_join.boundary([(8, 10, 0), (30, 1, 10)], 85) == 0
    assert jaccard_join.boundary([(8, 10, 10**6), (30, 1, 10)], 85) == 8
    assert jaccard_join.boundary([], 85) == 0


def test_jaccard_of_odd_tables(spark):
    df = docs_table(spark, ODD)
    assert jaccard_join.jaccard_components(df.limit(0)).count() == 0
    rows = jaccard_join.jaccard_components(df.union(df)).collect()
    assert {r.doc_id: r.component_id for r in rows} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 6}
    assert sorted(r.doc_id for r in jaccard_join.one_of_each(df).collect()) == [0, 1, 2, 3, 4, 5, 6]


def test_anchors_are_dealt_in_equal_parts():
    rng = random.Random(6)
    text = b" ".join(b"%x" % rng.randrange(1 << 24) for _ in range(40_000))
    w = suffix_dedup.Windows(np.array([len(text)], np.int64).tobytes(), zstandard.compress(text))
    assert set(w.anchors.tolist()) <= set(w.values.tolist()) and (np.diff(w.values.astype(object)) > 0).all()
    for found in (w.anchors, w.values):
        n = np.bincount(blocks.owners(found, 32), minlength=32)
        assert n.min() > 0 and n.max() < 2 * n.mean()
