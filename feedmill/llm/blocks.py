"""Documents packed into blocks, and the dealing of sorted hashes to owners."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import bytes_of, slices, whole, written

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK = 1 << 20


def pack(batches):
    """Blocks: number, ids, sizes and the texts, compressed."""
    part, count = TaskContext.get().partitionId(), 0
    squeeze = zstandard.ZstdCompressor(level=1)
    ids: list = []
    texts: list[bytes] = []
    size = 0
    schema = None

    def block():
        nonlocal ids, texts, size, count
        row = {
            "block": [(part << 32) + count], "ids": [ids], "sizes": [np.array([len(t) for t in texts], np.int64).tobytes()],
            "blob": [squeeze.compress(b"".join(texts))],
        }
        ids, texts, size, count = [], [], 0, count + 1
        return pa.RecordBatch.from_pydict(row, schema)

    for batch in slices(batches):
        schema = pa.schema(
            [("block", pa.int64()), ("ids", pa.list_(batch["id"].type)), ("sizes", pa.binary()), ("blob", pa.binary())]
        )
        for i, t in zip(batch["id"].to_pylist(), bytes_of(batch["text"]), strict=True):
            if texts and size + len(t) > BLOCK:
                yield block()
            ids.append(i), texts.append(t)
            size += len(t)
    if texts:
        yield block()


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A written table of blocks: block, ids, sizes and the compressed texts; null texts are empty."""
    kind = dict(docs.dtypes)[id_col]
    source = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    return written(source.mapInArrow(pack, f"block long, ids array<{kind}>, sizes binary, blob binary"), "blocks")


def unpacked(sizes: bytes, blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a block and where its documents start, plus the end."""
    edges = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64))])
    raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, int(edges[-1])))
    return np.frombuffer(raw, np.uint8), edges


def owners(values: np.ndarray, n: int) -> np.ndarray:
    return (((values >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def cuts(owner: np.ndarray) -> list[tuple[int, int, int]]:
    """(owner, start, end) of the runs of a sorted array."""
    if not len(owner):
        return []
    at = np.flatnonzero(np.diff(owner, prepend=-1))
    return list(zip(owner[at].tolist(), at.tolist(), [*at[1:].tolist(), len(owner)], strict=True))
