"""Exact dedup by an exchange of Golomb-coded fingerprints.

Partitions send the sorted 64-bit fingerprints of their texts, compressed, to
the owners of fingerprint ranges. Owners answer each sender with a bitmap of
those that another sender has too. Only documents under suspicion are then
shuffled, and their texts are compared byte by byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import golomb
from feedmill.llm.common import whole, written

#: Fingerprints of one owner, about: 8 bytes each once decoded.
OWNER_ROWS = 2_000_000


def normalised(text_col: str = "text"):
    return F.regexp_replace(whole(text_col), "[\\x20\\x09-\\x0D]+", " ")


def _unsigned(fps: pa.ChunkedArray) -> np.ndarray:
    return fps.to_numpy().astype(np.int64).view(np.uint64)


def _owners(values: np.ndarray, n_owners: int) -> np.ndarray:
    return ((values >> np.uint64(32)) * np.uint64(n_owners)) >> np.uint64(32)


def _encoder(n_owners: int):
    def encode(table: pa.Table) -> pa.Table:
        values = np.unique(_unsigned(table["fp"]))
        owner = _owners(values, n_owners).astype(np.int64)
        rows = {"sender": [], "owner": [], "code": []}
        for o in np.unique(owner):
            low = -((-int(o) << 32) // n_owners) << 32
            rows["sender"].append(table["sender"][0].as_py())
            rows["owner"].append(int(o))
            rows["code"].append(golomb.encode(values[owner == o], low, (1 << 64) // n_owners))
        return pa.table(rows, pa.schema([("sender", pa.int32()), ("owner", pa.int64()), ("code", pa.binary())]))

    return encode


def _answer(table: pa.Table) -> pa.Table:
    lists = [golomb.decode(c) for c in table["code"].to_pylist()]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    twice = values[counts > 1]
    maps = []
    for x in lists:
        at = np.minimum(np.searchsorted(twice, x), max(0, len(twice) - 1))
        maps.append(np.packbits(twice[at] == x).tobytes() if len(twice) else bytes(-(-len(x) // 8)))
    return pa.table({"sender": table["sender"], "owner": table["owner"], "bitmap": pa.array(maps, pa.binary())})


def _suspects(n_owners: int):
    def read(rows: pa.Table, maps: pa.Table) -> pa.Table:
        fps = _unsigned(rows["fp"])
        values, back, counts = np.unique(fps, return_inverse=True, return_counts=True)
        owner = _owners(values, n_owners).astype(np.int64)
        marked = counts > 1
        for o, bits in zip(maps["owner"].to_pylist(), maps["bitmap"].to_pylist(), strict=True):
            at = np.flatnonzero(owner == o)
            marked[at] |= np.unpackbits(np.frombuffer(bits, np.uint8))[: len(at)].astype(bool)
        return rows.select(["id", "fp"]).filter(pa.array(marked[back]))

    return read


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `id_col`, keep_id, group_size, kept, text_sha256, copies
    (rows with this id and text).

    Texts are equal when they are identical after each run of ASCII white space
    is made one space; null counts as empty. Of equal texts the smallest id is
    kept; a null id counts as the largest. Rows that repeat both id and text are
    documents of their own, of which one can be kept. An empty table gives an
    empty result; other columns are not read.
    """
    text = normalised(text_col)
    source = docs.select(F.col(id_col).alias("id"), text.alias("norm")).withColumn("fp", F.xxhash64("norm"))
    sha = F.sha2(F.col("norm").cast("binary"), 256)
    narrow = written(
        source.select("id", "fp", F.unhex(sha).alias("sha"), F.spark_partition_id().alias("sender")), "fingerprints"
    )
    n_owners = max(1, -(-narrow.count() // OWNER_ROWS))
    codes = (
        narrow.select("sender", "fp")
        .groupBy("sender")
        .applyInArrow(_encoder(n_owners), "sender int, owner long, code binary")
    )
    maps = codes.groupBy("owner").applyInArrow(_answer, "sender int, owner long, bitmap binary")
    id_type = narrow.schema["id"].dataType.simpleString()
    suspects = written(
        narrow.select("sender", "id", "fp")
        .groupBy("sender")
        .cogroup(maps.groupBy("sender"))
        .applyInArrow(_suspects(n_owners), f"id {id_type}, fp long")
        .select(F.col("id").alias("s_id"), F.col("fp").alias("s_fp"))
        .distinct(),
        "suspects",
    )
    # The bytes decide: rows of one group agree in the whole normalised text.
    texts = source.join(suspects, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("fp") == F.col("s_fp")), "left_semi")
    same = texts.groupBy("fp", "norm").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("n"))
    groups = (
        same.where("n > 1")
        .select(F.col("fp").alias("g_fp"), F.unhex(sha).alias("g_sha"), "keep", "n")
    )
    rows = narrow.groupBy("id", "fp", "sha").agg(F.count(F.lit(1)).alias("times"))
    joined = rows.join(groups, (F.col("fp") == F.col("g_fp")) & (F.col("sha") == F.col("g_sha")), "left")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep"))
    return joined.select(
        "id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.lower(F.hex("sha")).alias("text_sha256"), F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"), F.col("times").alias("copies"),
    ).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256", "copies",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `exact_dedup` keeps, with all their columns."""
    names = docs.columns
    decided = written(
        exact_dedup(docs, id_col, text_col).where("kept").select(
            F.col(id_col).alias("__id"), F.unhex("text_sha256").alias("__sha"), "copies"
        ),
        "kept-rows",
    )
    rows = docs.withColumn("__s", F.unhex(F.sha2(normalised(text_col).cast("binary"), 256)))
    match = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__s") == F.col("__sha"))
    once = rows.join(decided.where("copies = 1"), match, "left_semi").select(*names)
    if decided.where("copies > 1").isEmpty():
        return once
    again = rows.join(decided.where("copies > 1"), match, "left_semi")
    return once.unionByName(again.dropDuplicates([id_col, "__s"]).select(*names))
