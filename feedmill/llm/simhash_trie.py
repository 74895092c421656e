"""Near copies by SimHash: fingerprints, and a self-join of their binary trie.

1. Every text has a fingerprint of 64 bits: each bit is the majority of that bit
   over the hashes of the text's word shingles, repeats included.
2. Distinct fingerprints make a binary trie, cut at a depth where each subtree has
   at most `LEAVES` leaves. Subtrees meet in pairs, but only those whose paths
   differ in few enough bits.
3. A task walks down both subtrees of a pair together. Where the two paths take
   different turns the pair of nodes has one more differing bit, and pairs with more
   than `budget` of them are left. Nodes are ranges of a sorted array; all pairs of
   a level are walked at once.
4. Links become components. A pair of subtrees hands out at most one link per
   fingerprint, enough to hold together what hangs together in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import xxh64
from feedmill.llm.common import bytes_of, pieces, slices, whole, written
from feedmill.llm.components import components
from feedmill.llm.flat import LOWER, SPACE, joined

BITS = 64
#: Seed of the shingle hashes.
SEED = 42
#: Leaves of a subtree that a task holds; deeper cuts are chosen until subtrees are no larger.
LEAVES = 1 << 18
#: Depths at which the trie is cut. More pairs of subtrees than the first gives aren't needed for the work
#: to spread; beyond the last, subtrees are cut into slices by a hash instead.
DEPTHS = (6, 16)
#: Pairs of nodes that are walked at a time.
PAIRS = 1 << 18
#: Nodes of at most so many leaves are settled leaf by leaf; pairs of nodes that this is done for at a time.
LEAF = 16
COMPARED = 1 << 8
#: Shingles that are hashed at a time, and bytes of text.
SHINGLES = 1 << 17
TOGETHER = 1 << 20


def _one_space(buf: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts with one space after each: bytes, where words start and end, the first word of each text."""
    blank = SPACE[buf]
    blank[edges[1:] - 1] = True  # every text ends with a line feed of its own
    after = np.concatenate([[True], blank[:-1]])
    kept = ~(blank & after)
    ends = np.flatnonzero((blank & ~after)[kept])
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
    first = np.searchsorted(ends, np.concatenate([[0], np.cumsum(kept)])[edges])
    return np.where(blank, np.uint8(32), LOWER[buf])[kept], starts, ends, first


def fingerprints(texts: list[bytes], width: int) -> np.ndarray:
    """The fingerprints of texts in UTF-8; A-Z are lower-cased, words are divided by ASCII white space."""
    if not texts:
        return np.zeros(0, np.uint64)
    buf, starts, ends, first = _one_space(*joined(texts))
    words = np.diff(first)
    n = np.maximum(words - width + 1, (words > 0).astype(np.int64))  # shingles
    edges = np.concatenate([[0], np.cumsum(n)])
    ones = np.zeros((len(texts), BITS), np.int64)
    # Bits are counted in bytes, of at most 255 shingles each; a part ends with its text.
    for a in range(0, int(edges[-1]), SHINGLES):
        own = np.arange(a, min(a + SHINGLES, int(edges[-1])))
        text = np.searchsorted(edges, own, side="right") - 1
        head = first[text] + own - edges[text]
        hashes = xxh64.hashed(buf, starts[head], ends[head + np.minimum(width, words[text]) - 1], SEED)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").view(np.uint64).reshape(-1, 8)
        part = (own - edges[text]) // 255
        cut = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
        np.add.at(ones, text[cut], np.add.reduceat(bits, cut, axis=0).view(np.uint8).reshape(-1, BITS))
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def _fingerprints(width: int):
    def tell(batches):
        for batch in slices(batches):
            texts = bytes_of(batch["text"])
            parts = [fingerprints(texts[a:b], width) for a, b in pieces([len(t) for t in texts], TOGETHER)]
            found = np.concatenate([np.zeros(0, np.uint64), *parts])
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found.view(np.int64))], ["id", "fp"])

    return tell


class Trie:
    """The subtree of sorted distinct fingerprints: a node is a range of them that share their first bits."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([values, np.zeros(LEAF, np.uint64)]), LEAF)
        self._zeros: dict[int, np.ndarray] = {}

    def turn(self, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
        """Where the second child of each node starts, the node's children being told by `bit`."""
        zeros = self._zeros.get(bit)
        if zeros is None:
            zeros = np.zeros(len(self.values) + 1, np.int32)
            np.cumsum(((self.values >> np.uint64(bit)) & np.uint64(1)) == 0, out=zeros[1:])
            self._zeros[bit] = zeros
        return low + zeros[high] - zeros[low]


def _leaf_pairs(a: Trie, b: Trie, low: np.ndarray, low_b: np.ndarray, budget: int):
    """Pairs of leaves that differ in few enough bits, among the `LEAF` from `low` on and those from `low_b` on.

    A node has fewer leaves than that or as many; those behind it are compared as well, which does no harm.
    """
    found_a, found_b = [], []
    both, bits = np.empty((COMPARED, LEAF, LEAF), np.uint64), np.empty((COMPARED, LEAF, LEAF), np.uint8)
    for at in range(0, len(low), COMPARED):
        x, y = a.windows[low[at : at + COMPARED]], b.windows[low_b[at : at + COMPARED]]
        n = len(x)
        np.bitwise_count(np.bitwise_xor(x[:, :, None], y[:, None], out=both[:n]), out=bits[:n])
        hits = np.flatnonzero(bits[:n].ravel() <= budget)
        pair, i, j = np.unravel_index(hits, (n, LEAF, LEAF))
        found_a.append(low[at + pair] + i), found_b.append(low_b[at + pair] + j)
    none = np.zeros(0, np.int64)
    i, j = np.concatenate([none, *found_a]), np.concatenate([none, *found_b])
    there = (i < len(a.values)) & (j < len(b.values))
    if a is b:
        there &= i < j
    return i[there], j[there]


def near_pairs(a: Trie, b: Trie, budget: int):
    """Arrays (i, j) of leaves of `a` and `b` that differ in at most `budget` bits, part by part.

    For a subtree and itself i comes before j. A pair may come more than once.
    """
    if not len(a.values) or not len(b.values):
        return
    root = tuple(np.array([x], np.int64) for x in (0, len(a.values), 0, len(b.values), 0))
    open_ = [(BITS - 1, root)]
    while open_:
        bit, nodes = open_.pop()
        if len(nodes[0]) > PAIRS:
            half = len(nodes[0]) // 2
            open_ += [(bit, tuple(x[:half] for x in nodes)), (bit, tuple(x[half:] for x in nodes))]
            continue
        low, high, low_b, high_b, _ = nodes
        few = np.maximum(high - low, high_b - low_b) <= LEAF
        if few.any():
            yield _leaf_pairs(a, b, low[few], low_b[few], budget)
            nodes = tuple(x[~few] for x in nodes)
        if len(nodes[0]):
            low, high, low_b, high_b, differ = nodes
            cut, cut_b = a.turn(low, high, bit), b.turn(low_b, high_b, bit)
            turns = [
                (low, cut, low_b, cut_b, differ),
                (cut, high, cut_b, high_b, differ),
                (low, cut, cut_b, high_b, differ + 1),
                (cut, high, low_b, cut_b, differ + 1),
            ]
            nodes = tuple(np.concatenate(x) for x in zip(*turns, strict=True))
            low, high, low_b, high_b, differ = nodes
            stay = (low < high) & (low_b < high_b) & (differ <= budget)
            if a is b:
                stay &= low <= low_b
            open_.append((bit - 1, tuple(x[stay] for x in nodes)))


def forest(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One link from every linked number to the smallest that links lead to."""
    points, back = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j = back[: len(i)], back[len(i) :]
    label = np.arange(len(points))
    while True:
        least = np.minimum(label[i], label[j])
        far = label.copy()
        np.minimum.at(far, label[i], least)
        np.minimum.at(far, label[j], least)
        far = far[far]
        if (far == label).all():
            break
        label = far[label]
    rest = label != np.arange(len(points))
    return points[rest], points[label[rest]]


def _walk(budget: int):
    def walk(rows: pa.Table) -> pa.Table:
        # One row is a subtree and itself.
        tries = [Trie(np.sort(np.array(x.values, copy=False).view(np.uint64))) for x in rows["leaves"].combine_chunks()]
        a, b = tries[0], tries[-1]
        shift = 0 if a is b else len(a.values)
        every = a.values if a is b else np.concatenate([a.values, b.values])
        i, j, size = [], [], 0
        for x, y in near_pairs(a, b, budget):
            i.append(x), j.append(y + shift)
            size += len(x)
            if size > 4 * (len(every) + PAIRS):  # what hangs together is held by fewer links
                x, y = forest(np.concatenate(i), np.concatenate(j))
                i, j, size = [x], [y], len(x)
        none = np.zeros(0, np.int64)
        x, y = forest(np.concatenate([none, *i]), np.concatenate([none, *j]))
        values = every.view(np.int64)
        return pa.table({"a": pa.array(values[x], pa.int64()), "b": pa.array(values[y], pa.int64())})

    return walk


def _depth(fingerprints: DataFrame) -> tuple[int, int]:
    """The depth of the cut, and the slices of a subtree that is too large even so."""
    first = F.shiftrightunsigned("fp", BITS - DEPTHS[1])
    counts = fingerprints.groupBy(first.alias("path")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 65,536 rows
    for depth in range(*DEPTHS):
        sums: dict[int, int] = {}
        for row in counts:
            path = row["path"] >> (DEPTHS[1] - depth)
            sums[path] = sums.get(path, 0) + row["n"]
        if max(sums.values(), default=0) <= LEAVES:
            return depth, 1
    most = max(row["n"] for row in counts)
    return DEPTHS[1], -(-most // LEAVES)


def trie_links(fingerprints: DataFrame, budget: int) -> DataFrame:
    """Links (a, b) that hold together all values of `fp`, distinct ones, that differ in at most `budget` bits."""
    depth, n_slices = _depth(fingerprints)
    path = F.shiftrightunsigned("fp", BITS - depth)
    part = F.pmod(F.xxhash64("fp"), F.lit(n_slices))
    subtrees = fingerprints.groupBy(path.alias("path"), part.alias("part")).agg(F.collect_list("fp").alias("leaves"))
    near = F.array(*[F.lit(m).cast("long") for m in range(1 << depth) if m.bit_count() <= budget])
    slices_ = F.sequence(F.lit(0), F.lit(n_slices - 1)).cast("array<long>")
    met = subtrees.withColumn("mask", F.explode(near)).withColumn("other", F.explode(slices_))
    own = F.struct("path", "part")
    partner = F.struct(F.col("path").bitwiseXOR(F.col("mask")).alias("path"), F.col("other").alias("part"))
    pairs = met.select(F.least(own, partner).alias("one"), F.greatest(own, partner).alias("two"), "leaves")
    return pairs.groupBy("one", "two").applyInArrow(_together(budget), "a long, b long")


def _together(budget: int):
    """A pair of subtrees of which only one is there has nothing to find."""
    walk = _walk(budget)

    def work(key: tuple, rows: pa.Table) -> pa.Table:
        if rows.num_rows == 1 and key[0] != key[1]:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        return walk(rows)

    return work


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, budget: int = 4
) -> DataFrame:
    """One row per document: id, fingerprint (16 hexadecimal digits), component_id.

    component_id is the smallest id that links lead to, its own included; documents
    are linked whose fingerprints differ in at most `budget` bits. Texts are taken
    whole, null ones are empty; a text without words has fingerprint zero and is
    linked like any other, one of fewer words than `width` has one shingle. A null
    id counts as the largest. Rows that repeat an id are documents of their own.
    An empty table gives no rows; other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    marked = written(rows.mapInArrow(_fingerprints(width), f"id {kind}, fp long"), "fingerprints")
    first = written(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    labels = components(written(trie_links(first.select("fp"), budget), "found")).withColumnsRenamed({"v": "fp", "label": "top"})
    linked = first.join(labels, "fp", "left").withColumn("top", F.coalesce("top", "fp"))
    least = linked.groupBy("top").agg(F.min("least").alias("component_id"))
    classes = written(linked.select("fp", "top").join(least, "top").select(F.col("fp").alias("f"), "component_id"), "classes")
    return marked.join(classes, F.col("fp") == F.col("f")).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
