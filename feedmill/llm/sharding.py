"""Sharding by a hierarchical weighted hash tree, DataFrame functions only.

A document descends from the root to a region, a rack and a shard. At each level
every child draws from a hash of the document and the child's name, weighted by
the child's weight, and the largest draw wins. A draw depends on nothing but the
document, the child and its weight, so a changed weight moves rows only into or
out of the subtree that changed.

A shard that is added opens a region of its own (`grown`). Draws of the other
regions stay as they are, so the rows that move all go into the new shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import numbered, whole

#: (region, rack, shard, weight): what a tree is made of.
Leaf = tuple[str, str, int, float]


def tree(n_shards: int = 40, per_rack: int = 4, racks: int = 2) -> list[Leaf]:
    """Shards of weight 1, `per_rack` in a rack and `racks` in a region."""
    return [
        (f"region{i // (per_rack * racks)}", f"rack{i // per_rack % racks}", i, 1.0) for i in range(n_shards)
    ]


def grown(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, numbered next, in a region of its own."""
    shard = max((x[2] for x in leaves), default=-1) + 1
    return [*leaves, (f"region-of-{shard}", "rack0", shard, weight)]


def _children(leaves: list[Leaf]) -> dict[str, list[tuple[str, float, int]]]:
    """The children (path, weight, shard or -1) of the root, "", and of every region and rack."""
    out: dict[str, dict[str, tuple[float, int]]] = {}
    for region, rack, shard_no, weight in leaves:
        names = [region, rack, str(shard_no)]
        for level in range(3):
            node, child = "/".join(names[:level]), "/".join(names[: level + 1])
            so_far = out.setdefault(node, {}).get(child, (0.0, 0))[0]
            out[node][child] = (so_far + weight, shard_no if level == 2 else -1)
    return {n: [(c, *x) for c, x in kids.items()] for n, kids in out.items()}


def place(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of a key (a text column or any column; null is a key like others)."""
    kept = [x for x in leaves if x[3] > 0]
    if not kept:
        raise ValueError("a tree needs a shard of positive weight")
    text = F.coalesce(key.cast("string"), F.lit(""))
    table = F.create_map(
        *[
            x
            for node, kids in _children(kept).items()
            for x in (
                F.lit(node),
                F.array(
                    *[F.struct(F.lit(c).alias("path"), F.lit(w).alias("weight"), F.lit(i).alias("shard")) for c, w, i in kids]
                ),
            )
        ]
    )

    def draw(child: Column) -> Column:
        """log(u) / weight, with u in (0, 1) from the hash of key and child."""
        bits = F.shiftrightunsigned(F.xxhash64(text, child["path"]), 11)
        u = (bits + F.lit(0.5)) / F.lit(float(2**53))
        return F.struct((F.log(u) / child["weight"]).alias("draw"), child.alias("child"))

    node = F.lit("")
    for _ in range(3):
        best = F.array_max(F.transform(F.element_at(table, node), draw))["child"]
        node = best["path"]
    return best["shard"]


def shard(
    docs: DataFrame, leaves: list[Leaf] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `key`: id and tree decide. `slot` numbers the rows of a shard from
    0 without gaps. Null texts are empty; a null id is a key like others; rows
    that repeat an id share its shard and have slots of their own.
    """
    leaves = leaves or tree()
    text = F.encode(whole(text_col), "UTF-8")
    key = F.col(id_col)
    rows = docs.select(
        key,
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        place(key, leaves).alias("shard"),
        place(key, grown(leaves)).alias("grown_shard"),
    )
    order = [F.xxhash64(key), F.col(id_col), F.col("text_crc32"), F.col("size")]
    spread = [F.xxhash64(key, "text_crc32", "size")]
    return numbered(rows, ["shard"], order, "slot", spread, docs.count()).select(
        id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
