"""Similarity join of documents on word shingles, size-aware, light sets apart from heavy ones.

Links are pairs of sets whose intersection is at least `percent` of their union.

1. Equal sets are one set from here on.
2. Blocks tell owners of hash ranges, in Golomb code, which shingles they hold and
   hear back how frequent each is. A set that has too few shingles that any other
   has can't be linked; the others remain.
3. Light sets (few shingles) list all their subsets of the sizes that a common part
   may have. Sets that list the same subset and are small enough are linked; the
   smallest is joined to each of the others, which keeps what hangs together together.
4. Heavy sets are found by inverted lists of their rarest shingles. Every list
   joins its members to the one whose shingles are most frequent; pairs that prove similar make components.
   Lists that still hold several components have their other pairs compared, but
   for those whose signatures differ in too many bits.
5. The boundary between light and heavy is the size where the estimated number of
   subsets and list entries is least.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import blocks as packing
from feedmill.llm import flat, golomb
from feedmill.llm.common import written
from feedmill.llm.components import components

#: Bits of a shingle's hash that the count of its documents goes by.
COUNT_BITS = 40
#: No boundary beyond this size is considered; subsets of larger sets are too many in any case.
MAX_LIGHT = 40
#: A signature has one bit per hash class of a set's shingles, set when the class has an odd number of them.
#: Two sets differ in at least as many shingles as their signatures in bits.
SIGNATURE = [f"bits{i}" for i in range(16)]
SALTS = np.random.default_rng(7).integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)


def least_common(n: int, percent: int) -> int:
    """Shingles that a set of n shares at least with any set that it is linked with."""
    return -(-percent * n // 100)


def shingled(buf: np.ndarray, edges: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a block.

    A-Z are lower-cased; words are runs of anything but ASCII white space. A
    document of fewer words than `width` has one shingle, its whole sequence.
    """
    texts = [buf[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    joined, at = flat.joined(texts)
    joined = flat.LOWER[joined]
    starts, ends = flat.words(joined)
    words = flat.spans_hashed(joined, starts, ends)
    first = np.searchsorted(starts, at)
    n = np.diff(first)
    grams = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        grams += words[k : k + len(grams)] * SALTS[k]
    grams = flat.mixed(grams)
    out = []
    for f, k in zip(first.tolist(), n.tolist(), strict=False):
        if k >= width:
            out.append(np.unique(grams[f : f + k - width + 1]))
        else:
            mark = sum(int(w) * int(SALTS[i + 8]) for i, w in enumerate(words[f : f + k])) + k
            out.append(flat.mixed(np.array([mark % 2**64], np.uint64)) if k else np.zeros(0, np.uint64))
    return out


def _describe(width: int):
    def describe(batches):
        for batch in batches:
            for block, ids, sizes, blob in zip(*(batch[c].to_pylist() for c in ("block", "ids", "sizes", "blob")), strict=True):
                sets = shingled(*packing.unpacked(sizes, blob), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block] * len(ids), pa.int64()), pa.array(range(len(ids)), pa.int64()),
                        pa.array(ids, batch.schema.field("ids").type.value_type), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    ],
                    ["block", "place", "id", "n", "sid"],
                )

    return describe


def _places(table: pa.Table) -> np.ndarray:
    """The documents of a block that stand for their set."""
    return np.sort(table["place"].to_numpy()) if table.num_rows else np.zeros(0, np.int64)


def _count(width: int, n_owners: int):
    def count(rows: pa.Table, chosen: pa.Table) -> pa.Table:
        out: dict[str, list] = {"block": [], "owner": [], "code": [], "counts": []}
        for block, sizes, blob in zip(*(rows[c].to_pylist() for c in ("block", "sizes", "blob")), strict=True):
            sets = shingled(*packing.unpacked(sizes, blob), width)
            held = [sets[i] >> np.uint64(64 - COUNT_BITS) for i in _places(chosen)]
            values, counts = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
            owner = packing.owners(values << np.uint64(64 - COUNT_BITS), n_owners)
            for o, a, b in packing.cuts(owner):
                low = (-((-o << 32) // n_owners) << 32) >> (64 - COUNT_BITS)
                out["block"].append(block), out["owner"].append(o)
                out["code"].append(golomb.encode(values[a:b], low, (1 << COUNT_BITS) // n_owners))
                out["counts"].append(counts[a:b].astype(np.uint32).tobytes())
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds, strict=True)})

    return count


def _rank(table: pa.Table) -> pa.Table:
    """How frequent each shingle is, as the logarithm of the sets that have it: 0 for one set."""
    lists = [golomb.decode(x) for x in table["code"].to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()]).astype(np.int64)
    values = np.concatenate(lists)
    order = np.argsort(values, kind="stable")
    first = np.flatnonzero(np.diff(values[order], prepend=~values[order[:1]]))
    sums = np.add.reduceat(counts[order], first) if len(first) else counts
    level = np.empty(len(values), np.uint8)
    level[order] = np.repeat(np.frexp(sums.astype(float))[1] - 1, np.diff(np.append(first, len(values))))
    parts = np.split(level, np.cumsum([len(x) for x in lists])[:-1])
    return pa.table(
        {"block": table["block"], "owner": table["owner"], "levels": pa.array([p.tobytes() for p in parts], pa.binary())}
    )


def _remain(width: int, percent: int):
    """Sets that may have a partner: their shingles that others have too, rarest first."""

    def remain(rows: pa.Table, news: pa.Table) -> pa.Table:
        out: dict[str, list] = {"sid": [], "n": [], "alone": [], "shared": [], "levels": []}
        marks: list[np.ndarray] = [np.zeros((0, len(SIGNATURE)), np.int64)]
        told = news.filter(pc.is_valid(news["levels"]))
        places = _places(news.filter(pc.is_null(news["levels"])))
        order = np.argsort(told["owner"].to_numpy(), kind="stable")
        cells = told["levels"].to_pylist()
        level = np.frombuffer(b"".join([cells[i] for i in order]), np.uint8)
        for sizes, blob in zip(*(rows[c].to_pylist() for c in ("sizes", "blob")), strict=True):
            sets = shingled(*packing.unpacked(sizes, blob), width)
            held = [sets[i] >> np.uint64(64 - COUNT_BITS) for i in places]
            values = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]))
            for i, short in zip(places.tolist(), held, strict=True):
                own, n = level[np.searchsorted(values, short)], len(short)
                common = own > 0
                if n and common.sum() >= least_common(n, percent):
                    shared, own = sets[i][common], own[common]
                    by = np.lexsort((shared, own))
                    out["sid"].append(xxhash.xxh3_128_digest(sets[i].tobytes()))
                    out["n"].append(n), out["alone"].append(n - len(shared))
                    out["shared"].append(shared[by].tobytes()), out["levels"].append(own[by].tobytes())
                    classes = (sets[i] >> np.uint64(20)) % np.uint64(64 * len(SIGNATURE))
                    odd = np.bincount(classes.astype(np.int64), minlength=64 * len(SIGNATURE)) & 1
                    marks.append(np.packbits(odd.astype(np.uint8)).view(np.int64)[None])
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        table = {c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds, strict=True)}
        bits = np.concatenate(marks)
        return pa.table(table | {c: pa.array(bits[:, i].copy(), pa.int64()) for i, c in enumerate(SIGNATURE)})

    return remain


def subsets(n: int, percent: int) -> int:
    """Subsets that a set of n lists when it is light."""
    return sum(comb(n, c) for c in range(least_common(n, percent), n + 1))


def boundary(sizes: list[tuple[int, int, int]], percent: int) -> int:
    """The largest light size, where subsets and list entries together are fewest.

    `sizes` has (size, sets of it, entries of the lists that they would scan).
    """
    best, cost = 0, sum(scan for _, _, scan in sizes)
    least = cost
    for n, k, scan in sorted(sizes):
        if n > MAX_LIGHT:
            break
        cost += k * subsets(n, percent) - scan
        if cost <= least:
            best, least = n, cost
    return best


def _scan_cost(percent: int):
    def cost(batches):
        for batch in batches:
            n = batch["n"].to_numpy(zero_copy_only=False)
            alone = batch["alone"].to_numpy(zero_copy_only=False)
            totals = []
            for k, a, levels in zip(n.tolist(), alone.tolist(), batch["levels"].to_pylist(), strict=True):
                prefix = np.frombuffer(levels, np.uint8)[: k - least_common(k, percent) + 1 - a]
                totals.append(int(np.left_shift(1, prefix.astype(np.int64)).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(totals, pa.int64())], ["n", "scan"])

    return cost


def _list_subsets(percent: int):
    """(subset, its size, sid, n) of every light set."""

    def listed(batches):
        for batch in batches:
            for sid, n, alone, shared in zip(*(batch[c].to_pylist() for c in ("sid", "n", "alone", "shared")), strict=True):
                values = np.frombuffer(shared, np.uint64)
                marks, sizes = [], []
                # A shingle that no other set has is in no common part.
                for c in range(least_common(n, percent), n - alone + 1):
                    # Which to leave out: the sum of mixed hashes tells a subset.
                    left_out = list(combinations(range(len(values)), len(values) - c))
                    out = np.array(left_out, np.int64).reshape(len(left_out), len(values) - c)
                    spread = flat.mixed(values ^ SALTS[15])
                    left = spread[out].sum(axis=1, dtype=np.uint64)
                    marks.append(flat.mixed(spread.sum(dtype=np.uint64) - left).view(np.int64))
                    sizes.append(np.full(len(out), c, np.int64))
                if marks:
                    k = sum(map(len, marks))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(marks)), pa.array(np.concatenate(sizes)), pa.array([sid] * k, pa.binary()), pa.array([n] * k, pa.int64())],
                        ["subset", "c", "sid", "n"],
                    )

    return listed


def _list_prefixes(percent: int, light: int):
    """(shingle, sid, n, rest, known) of the rarest shingles of every set.

    rest: shingles from here on; known: how frequent the set's shingles are, on average.
    """

    def listed(batches):
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            columns = (batch[c].to_pylist() for c in ("sid", "n", "alone", "shared", "levels"))
            for sid, n, alone, shared, levels in zip(*columns, strict=True):
                values = np.frombuffer(shared, np.int64)
                k = min(len(values), n - least_common(n, percent) + 1 - alone)
                rows[0].append(values[:k]), rows[3].append(len(values) - np.arange(k))
                known = 1000 * int(np.frombuffer(levels, np.uint8).sum(dtype=np.int64)) // n
                rows[1].extend([sid] * k), rows[2].extend([n] * k), rows[4].extend([known] * k)
            if rows[0]:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(rows[0])), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.int64()),
                        pa.array(np.concatenate(rows[3])), pa.array(rows[4], pa.int64()),
                    ],
                    ["shingle", "sid", "n", "rest", "known"],
                )

    return listed


def _linked(percent: int):
    """Keeps the pairs whose sets are similar enough."""

    def linked(batches):
        for batch in batches:
            keep = []
            columns = (batch[c].to_pylist() for c in ("n_a", "n_b", "set_a", "set_b"))
            for n, m, x, y in zip(*columns, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(100 * both >= percent * (n + m - both))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return linked


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    side = lambda x: sets.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("shared").alias(f"set_{x}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(_linked(percent), "a binary, b binary")


def _near(n: str, m: str, percent: int):
    """Sizes that a link allows."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _mixed_lists(entries: DataFrame, labels: DataFrame, light: int) -> DataFrame:
    """Entries, with their component, of the lists that hold several components and a heavy set."""
    placed = entries.join(labels.withColumnRenamed("v", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    mixed = placed.groupBy("shingle").agg(F.min("label").alias("one"), F.max("label").alias("other"), F.max("n").alias("most"))
    mixed = mixed.where((F.col("one") != F.col("other")) & (F.col("most") > light)).select("shingle")
    return placed.join(mixed, "shingle", "left_semi")


def set_components(sets: DataFrame, percent: int) -> DataFrame:
    """(v, label) of distinct sets that are linked; label is the same for all that hang together."""
    by_size = sets.where(F.col("n") <= MAX_LIGHT).select("n", "alone", "levels").mapInArrow(_scan_cost(percent), "n long, scan long")
    counts = by_size.groupBy("n").agg(F.count(F.lit(1)).alias("k"), F.sum("scan").alias("scan")).collect()  # MAX_LIGHT rows
    light = boundary([(r["n"], r["k"], r["scan"]) for r in counts], percent)

    listed = sets.where(F.col("n") <= light).mapInArrow(_list_subsets(percent), "subset long, c long, sid binary, n long")
    least = listed.groupBy("subset", "c").agg(F.min(F.struct("n", "sid")).alias("least"), F.count(F.lit(1)).alias("k"))
    fits = F.col("c") * (100 + percent) >= (F.col("n") + F.col("least.n")) * percent
    light_links = (
        listed.join(least.where("k > 1"), ["subset", "c"])
        .where((F.col("sid") != F.col("least.sid")) & fits)
        .select(F.col("least.sid").alias("a"), F.col("sid").alias("b"))
    )

    entries = written(
        sets.mapInArrow(_list_prefixes(percent, light), "shingle long, sid binary, n long, rest long, known long"), "lists"
    )
    # A set whose shingles are frequent has few changes of its own: copies that differ in theirs are like it, if not like each other.
    heads = entries.groupBy("shingle").agg(
        F.max(F.struct("known", "sid", "n")).alias("head"), F.count(F.lit(1)).alias("k"), F.max("n").alias("most")
    )
    # A list of light sets alone has nothing to find.
    heads = heads.where((F.col("k") > 1) & (F.col("most") > light))
    heads = heads.select("shingle", F.col("head.sid").alias("a"), F.col("head.n").alias("n_a"))
    stars = entries.join(heads, "shingle").where((F.col("sid") != F.col("a")) & _near("n", "n_a", percent))
    tried = written(stars.select(F.least("a", "sid").alias("a"), F.greatest("a", "sid").alias("b")).distinct(), "pairs")
    found = written(light_links.distinct().unionByName(_verified(tried, sets, percent)), "found")

    labels = written(components(found), "labels")
    open_ = _mixed_lists(entries, labels, light).join(sets.select("sid", *SIGNATURE), "sid")
    open_ = written(open_, "open")
    other = open_.select(
        "shingle", F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("rest").alias("rest_b"), F.col("label").alias("label_b"),
        *[F.col(c).alias(f"{c}_b") for c in SIGNATURE],
    )
    # At the first common shingle of a similar pair, what is left of either set must do.
    enough = F.least("rest", "rest_b") * (100 + percent) >= (F.col("n") + F.col("n_b")) * percent
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_b"))) for c in SIGNATURE), F.lit(0))
    alike = (F.col("n") + F.col("n_b") - differ) * (100 + percent) >= (F.col("n") + F.col("n_b")) * (2 * percent)
    pairs = (
        open_.join(other, "shingle")
        .where((F.col("label") < F.col("label_b")) & (F.greatest("n", "n_b") > light) & _near("n", "n_b", percent) & enough & alike)
        .select(F.least("sid", "b").alias("a"), F.greatest("sid", "b").alias("b"))
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    # What the late links join are components: of the links between two of them one is enough.
    late = _verified(pairs, sets, percent)
    for end in ("a", "b"):
        known = labels.select(F.col("v").alias(end), F.col("label").alias(f"label_{end}"))
        late = late.join(known, end, "left").withColumn(f"label_{end}", F.coalesce(f"label_{end}", end))
    joined = written(late.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct(), "found")
    upper = components(joined).select(F.col("v").alias("label"), F.col("label").alias("top"))
    lone = upper.select(F.col("label").alias("v"), "top").join(labels.select("v"), "v", "left_anti")
    lower = labels.join(upper, "label", "left").select("v", F.coalesce("top", "label").alias("label"))
    return lower.unionByName(lone.select("v", F.col("top").alias("label")))


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id that links lead to, its own included).

    A document without words has no shingles and no links. Null texts are empty.
    Equal sets are linked. A null id counts as the largest; rows that repeat an
    id are documents of their own. An empty table gives no rows; other columns
    are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    blocks = packing.packed(docs, id_col, text_col)
    n_blocks = blocks.count()
    n_owners = max(1, n_blocks // 4)
    rows = written(
        blocks.mapInArrow(_describe(width), f"block long, place long, id {kind}, n long, sid binary"), "sets"
    )
    first = rows.where("n > 0").groupBy("sid").agg(F.min(F.struct("block", "place")).alias("at"), F.min("id").alias("least"))
    first = written(first.select("sid", "at.block", "at.place", "least"), "first")

    texts = blocks.select("block", "sizes", "blob")
    counted = texts.groupBy("block").cogroup(first.select("block", "place").groupBy("block")).applyInArrow(
        _count(width, n_owners), "block long, owner long, code binary, counts binary"
    )
    levels = counted.groupBy("owner").applyInArrow(_rank, "block long, owner long, levels binary")
    news = levels.withColumn("place", F.lit(None).cast("long")).unionByName(
        first.select("block", F.lit(None).cast("long").alias("owner"), F.lit(None).cast("binary").alias("levels"), "place")
    )
    sets = written(
        texts.groupBy("block").cogroup(news.groupBy("block")).applyInArrow(
            _remain(width, percent), "sid binary, n long, alone long, shared binary, levels binary, " + ", ".join(f"{c} long" for c in SIGNATURE)
        ),
        "remaining",
    )
    labels = set_components(sets, percent)
    classed = first.join(labels.withColumnRenamed("v", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    least = classed.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = written(classed.select("sid", "label").join(least, "label").select(F.col("sid").alias("s"), "component_id"), "classes")
    joined = rows.join(classes, (F.col("sid") == F.col("s")) & (F.col("n") > 0), "left")
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The rows of `docs` whose id is that of their component; rows without an id stay.

    Rows that repeat an id stay if one of them is the first of its component.
    """
    found = jaccard_components(docs, id_col, text_col, **more)
    first = F.max(F.col(id_col) == F.col("component_id"))
    gone = written(found.groupBy(F.col(id_col).alias("__id")).agg(first.alias("first")).where("not first").select("__id"), "gone")
    return docs.join(gone, F.col(id_col) == F.col("__id"), "left_anti").select(*docs.columns)
