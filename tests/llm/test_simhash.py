"""SimHash fingerprints and the trie join against plain versions."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from feedmill.llm import simhash_trie, xxh64
from feedmill.llm.simhash_trie import Trie, fingerprints, forest, near_pairs, simhash_components
from tests.llm.helpers import docs_table, lower, prose, some_texts, words


def plain(text, width=4):
    w = words(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(texts, budget=4):
    marks = [plain(t) for t in texts]
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(marks):
            for j, y in enumerate(marks):
                if (x ^ y).bit_count() <= budget and label[j] < label[i]:
                    label[i], changed = label[j], True
    return {i: (f"{marks[i]:016x}", label[i]) for i in range(len(texts))}


def test_hashes_of_all_lengths():
    rng = np.random.default_rng(0)
    buf = rng.integers(0, 256, 4000, dtype=np.uint8)
    starts = np.arange(400)
    ends = starts + np.arange(400) % 200
    wanted = [xxhash.xxh64_intdigest(buf[a:b].tobytes(), 42) for a, b in zip(starts, ends, strict=True)]
    assert xxh64.hashed(buf, starts, ends, 42).tolist() == wanted


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(simhash_trie, "SHINGLES", 300)
    texts = [*[t for t in some_texts(1) if t is not None], "a\x0bB  c\n", "ÄB ä", "w " * 900, prose(random.Random(1), 2000), ""]
    assert fingerprints([t.encode() for t in texts], 4).tolist() == [plain(t) for t in texts]


def near_values(seed, n, flips=6):
    """Numbers of which many differ in few bits."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = rng.choice(out) if out and rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randrange(flips)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("budget", [0, 1, 4, 9])
def test_near_pairs(budget, monkeypatch):
    monkeypatch.setattr(simhash_trie, "PAIRS", 50)
    values = near_values(budget, 300)
    wanted = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= budget}
    one = Trie(values)
    assert {p for i, j in near_pairs(one, one, budget) for p in zip(i.tolist(), j.tolist(), strict=True)} == wanted
    half = len(values) // 2
    low, high = Trie(values[:half]), Trie(values[half:])
    across = {(i, j + half) for x, y in near_pairs(low, high, budget) for i, j in zip(x.tolist(), y.tolist(), strict=True)}
    assert across == {(i, j) for i, j in wanted if i < half <= j}


def test_forest():
    i, j = np.array([5, 7, 9, 2]), np.array([7, 9, 5, 3])
    assert dict(zip(*(x.tolist() for x in forest(i, j)), strict=True)) == {7: 5, 9: 5, 3: 2}


def chain(n, seed=5):
    """Copies of a text, each with a few words more changed than the one before."""
    rng = random.Random(seed)
    w, out = prose(rng, 300).split(), []
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("leaves", "depths"), [(1 << 18, (6, 16)), (4, (1, 8)), (2, (1, 2))])
def test_components(spark, monkeypatch, leaves, depths):
    """With few leaves to a subtree the cut goes deeper, and at last subtrees are cut into slices."""
    monkeypatch.setattr(simhash_trie, "LEAVES", leaves)
    monkeypatch.setattr(simhash_trie, "DEPTHS", depths)
    texts = [*some_texts(2), *chain(25), *some_texts(2, 12)]
    found = {r["doc_id"]: tuple(r[1:]) for r in simhash_components(docs_table(spark, texts)).collect()}
    assert found == plain_components(texts)


def test_odd_tables(spark):
    assert simhash_components(spark.createDataFrame([], "doc_id string, text string")).count() == 0
    rows = spark.createDataFrame(
        [(3, "one two three four five"), (None, "one two three four five"), (3, None), (None, "alone here"), (9, " "), (4, "x " * 200_000)],
        "doc_id int, text string",
    )
    clash = rows.withColumns({c: F.lit(1) for c in ("id", "fp", "f", "top", "least", "path", "v", "label")})
    found = sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash_components(clash).collect())
    assert found == [("3", "3"), ("3", "3"), ("4", "4"), ("9", "3"), ("None", "3"), ("None", "None")]
