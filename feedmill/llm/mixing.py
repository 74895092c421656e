"""Mixing sources to target weights by proportionate-fair scheduling.

A source of weight w owes block k to the mix not before slot floor(k / w) and
before slot ceil((k + 1) / w). In every slot the released block with the
earliest deadline runs. With weights that are whole numbers of a cycle of slots
the schedule repeats from cycle to cycle, so one cycle, a table of fixed size,
places any number of blocks: block k of a source of share a runs in cycle
k // a, in that source's slot number k % a.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import numbered

#: Slots of one cycle: weights are whole multiples of 1 / CYCLE.
CYCLE = 4096
#: Documents of one block.
BLOCK_DOCS = 64
#: Whole documents of one numbering bucket.
WIDE_ROWS = 4_000
#: Sources with a class of their own; the rest share one and are mixed in it at random.
MAX_CLASSES = 1024
#: Target weights are proportional to the documents of a source to this power.
POWER = 0.9
REST = "(other sources)"
MISSING = "(no source)"
ADDED = ["mix_class", "mix_epoch", "mix_block", "mix_slot", "mix_rank"]


def shares(weights: dict[str, float], cycle: int = CYCLE) -> dict[str, int]:
    """Whole slots per cycle, at least 1 each, that sum to `cycle`: largest remainders."""
    total = math.fsum(weights.values())
    if not weights or not total > 0 or min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    if len(weights) > cycle:
        raise ValueError(f"{len(weights)} sources need a cycle of as many slots")
    exact = {s: Fraction(w) / Fraction(total) * (cycle - len(weights)) for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    short = cycle - sum(out.values())
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[:short]:
        out[s] += 1
    return out


def one_cycle(share: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, number in the cycle, slot) for a whole cycle, earliest deadline first."""
    cycle = sum(share.values())
    release: list[list[tuple[int, str, int]]] = [[] for _ in range(cycle)]
    for s, a in share.items():
        for k in range(a):
            release[k * cycle // a].append((-(-(k + 1) * cycle // a), s, k))
    ready: list[tuple[int, str, int]] = []
    out = []
    for slot in range(cycle):
        for block in release[slot]:
            heapq.heappush(ready, block)
        deadline, s, k = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a block missed its deadline")
        out.append((s, k, slot))
    return out


def mix(
    docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source",
    block_docs: int = BLOCK_DOCS, seed: int = 0, bucket_rows: int | None = None,
) -> DataFrame:
    """The mix: a row of `docs`, with all its columns, for every time it is used.

    Added: mix_class, mix_epoch, mix_block (of its source), mix_slot and mix_rank
    (in the block). The mix is as long as it takes to use every document at
    least once; a source whose weight asks for more than it has starts over, so
    nothing is dropped. Until any slot t a source of weight w has run w * t
    blocks, give or take less than one. Inside a source the order is that of a
    seeded hash. Without `weights`, they follow the documents of each source to
    the power `POWER`. Sources not in `weights` (or beyond the `MAX_CLASSES`
    largest) share one class, whose weight is the sum of theirs; without weights
    of their own they get their part of the documents. A null source is a source.
    An empty table gives no rows. The added columns replace others of their names.
    """
    spark = docs.sparkSession
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(MISSING))
    counts = docs.groupBy(source.alias("s")).agg(F.count(F.lit(1)).alias("n"))
    named = list(weights) if weights else [
        r["s"] for r in counts.orderBy(F.desc("n"), "s").limit(MAX_CLASSES).collect()
    ]
    known = spark.createDataFrame([(s,) for s in named], "s string")
    sized = counts.join(known.withColumn("named", F.lit(True)), "s", "left")
    by_class = sized.groupBy(F.when(F.col("named"), F.col("s")).otherwise(F.lit(REST)).alias("s")).agg(F.sum("n").alias("n"))
    sizes = {r["s"]: r["n"] for r in by_class.collect()}  # a row per class, MAX_CLASSES + 1 at most
    if not sizes:
        sizes = {REST: 0}
    if weights:
        asked = {s: w for s, w in weights.items() if s in sizes}
        part = sizes.get(REST, 0) / max(1, sum(sizes.values()))
        if REST in sizes:
            asked[REST] = (math.fsum(asked.values()) or 1.0) * part / max(1e-9, 1 - part) if part < 1 else 1.0
    else:
        asked = {s: max(n, 1) ** POWER for s, n in sizes.items()}
    share = shares(asked, max(CYCLE, 2 * len(asked)))
    cycle = sum(share.values())
    blocks = {s: -(-n // block_docs) for s, n in sizes.items()}
    n_cycles = max((Fraction(blocks[s], share[s]) for s in share), default=Fraction(0))
    # Slots until every document has been used; each source runs its blocks before that slot.
    length = math.ceil(n_cycles * cycle)
    plan = spark.createDataFrame(
        [(s, blocks[s], share[s], length) for s in share], "p_class string, p_blocks long, p_share long, p_length long"
    )
    slots = spark.createDataFrame(one_cycle(share), "c_class string, c_number long, c_slot long")

    # The row travels as one column, so that no name of it meets those used here.
    whole = docs.drop(*[c for c in ADDED if c != id_col and c != source_col])
    packed = whole.select(
        F.xxhash64(F.col(id_col), F.lit(seed)).alias("__key"), F.col(id_col).alias("__id"), source.alias("__source"), F.struct("*").alias("__row")
    )
    rows = packed.join(F.broadcast(known.select(F.col("s").alias("__named"))), F.col("__source") == F.col("__named"), "left")
    rows = rows.withColumn("mix_class", F.coalesce("__named", F.lit(REST))).drop("__source", "__named")
    return _placed(rows, plan, slots, cycle, block_docs, sum(sizes.values()), bucket_rows)


def _placed(rows, plan, slots, cycle, block_docs, n_rows, bucket_rows) -> DataFrame:
    same = F.xxhash64("__row")
    ranked = numbered(rows, ["mix_class"], [F.col("__key"), F.col("__id"), same], "__number", [F.col("__key"), same], n_rows, bucket_rows)
    block = F.floor(F.col("__number") / block_docs)
    first = ranked.withColumn("__block", block).join(F.broadcast(plan), F.col("mix_class") == F.col("p_class"))
    # Block b of a source comes as its blocks b, b + n, b + 2 n, ... in the mix.
    runs = F.ceil(F.col("p_length") * F.col("p_share") / F.lit(cycle)) + 1
    epochs = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((runs - F.col("__block") - 1) / F.col("p_blocks")).cast("long")))
    used = first.withColumn("mix_epoch", F.explode(epochs)).withColumn("mix_block", F.col("__block") + F.col("mix_epoch") * F.col("p_blocks"))
    slot = F.floor(F.col("mix_block") / F.col("p_share")) * cycle + F.col("c_slot")
    return (
        used.join(F.broadcast(slots), (F.col("mix_class") == F.col("c_class")) & (F.pmod(F.col("mix_block"), F.col("p_share")) == F.col("c_number")))
        .withColumn("mix_slot", slot.cast("long"))
        .where((F.col("mix_slot") < F.col("p_length")) | (F.col("mix_epoch") == 0))
        .withColumn("mix_rank", F.pmod(F.col("__number"), F.lit(block_docs)).cast("int"))
        .select("__row.*", "mix_class", F.col("mix_epoch").cast("int"), F.col("mix_block").cast("long"), "mix_slot", "mix_rank")
    )


def mixed_rows(
    docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source", **more
) -> DataFrame:
    """The mix as rows of `docs`, in its order: files follow one another by slot."""
    packed = docs.select(F.col(id_col).alias("i"), F.col(source_col).alias("s"), F.struct(*docs.columns).alias("row"))
    mixed = mix(packed, weights, "i", "s", bucket_rows=WIDE_ROWS, **more)
    return mixed.repartitionByRange("mix_slot", "mix_rank").sortWithinPartitions("mix_slot", "mix_rank").select("row.*")
