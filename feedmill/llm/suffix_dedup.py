"""Removal of repeated 200-byte strings with suffix arrays.

Documents are packed into blocks. Every window of 200 bytes is known by the
smallest hash of a gram inside it, its anchor, so equal windows have equal
anchors. Blocks tell the owners of anchor ranges what they hold and hear which
anchors occur twice anywhere; no other window can have a twin. Of the remaining
windows, those of one anchor that are neighbours form a segment. Segments are
dealt by anchor to shards, equal ones of a block once, a row for each.

A shard sorts the suffixes of its distinct segments by Larsson-Sadakane
refinement, finds common prefixes of neighbours as Kasai does (a position whose
predecessor agrees inherits its length less one) and so the windows that occur
twice. (A segment of which there are two needs no comparison; it is sorted with
those of its anchor of which there is one.) Shards that share an anchor too frequent for one task get its windows one
by one, dealt by the windows' own hash. The verdicts are merged into the blocks
by binary search.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import blocks as packing
from feedmill.llm.common import pieces, written
from feedmill.llm.flat import mixed, ranges, rolling, spans_hashed

WINDOW = 200
GRAM = 64
#: Bytes of segments whose suffixes are sorted together.
SHARD = 3 << 19
#: Bytes of segments that a task hands over at a time.
PART = 1 << 25
#: An anchor with more occurrences has its windows dealt one by one.
HOT = 5_000


def _sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over every w neighbours, in three passes: prefixes and suffixes of rows of w."""
    if len(x) < w:
        return x[:0]
    n = -(-len(x) // w) * w
    rows = np.concatenate([x, np.full(n - len(x), x[-1], x.dtype)]).reshape(-1, w)
    before = op.accumulate(rows, axis=1).ravel()
    after = op.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(after[: len(x) - w + 1], before[w - 1 : len(x)])


class Windows:
    """The windows of a block: their anchors, the segments they form, and the bytes."""

    def __init__(self, sizes: bytes, blob: bytes):
        self.buf, self.edges = packing.unpacked(sizes, blob)
        total = len(self.buf)
        empty = np.zeros(0, np.int64)
        self.starts, self.ends, self.anchors = empty, empty, np.zeros(0, np.uint64)
        self.values, self.counts = np.zeros(0, np.uint64), empty
        if total < WINDOW:
            return
        grams = rolling(self.buf, GRAM)
        w = WINDOW - GRAM + 1
        least = _sliding(grams, w, np.minimum)  # of the window that starts here
        valid = np.zeros(len(least) + 1, bool)  # windows inside one document
        for a, b in zip(self.edges[:-1].tolist(), self.edges[1:].tolist(), strict=True):
            if b - a >= WINDOW:
                valid[a : b - WINDOW + 1] = True
        change = np.empty(len(least), bool)
        change[0] = True
        change[1:] = (least[1:] != least[:-1]) | (valid[1:-1] != valid[:-2])
        change[self.edges[(self.edges > 0) & (self.edges < len(least))]] = True
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], len(least))
        inside = valid[starts]
        self.starts, self.ends = starts[inside], ends[inside]
        # Minima lie near 0. They are mixed before they are dealt, so that equal ranges hold equal parts.
        self.anchors = mixed(least[self.starts])
        # Every gram that is the least of some window counts as an occurrence of its anchor.
        shown = np.where(valid[:-1], least, np.uint64(0))
        pad = np.zeros(w - 1, np.uint64)
        chosen = grams == _sliding(np.concatenate([pad, shown, pad]), w, np.maximum)[: len(grams)]
        self.values, self.counts = np.unique(mixed(grams[chosen]), return_counts=True)


def _tell(n_owners: int):
    def tell(batches):
        for batch in batches:
            for block, sizes, blob in zip(*(batch[c].to_pylist() for c in ("block", "sizes", "blob")), strict=True):
                w = Windows(sizes, blob)
                rows = [
                    (block, o, w.values[a:b].tobytes(), w.counts[a:b].astype(np.uint32).tobytes())
                    for o, a, b in packing.cuts(packing.owners(w.values, n_owners))
                ]
                names = ["block", "owner", "hashes", "counts"]
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names
                )

    return tell


def _answer(hot: int):
    def answer(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()]).astype(np.int64)
        values = np.concatenate(lists)
        order = np.argsort(values, kind="stable")
        first = np.flatnonzero(np.diff(values[order], prepend=~values[order[:1]]))
        sums = np.add.reduceat(counts[order], first) if len(first) else counts
        code = np.empty(len(values), np.uint8)
        code[order] = np.repeat((sums > 1).astype(np.uint8) + (sums > hot), np.diff(np.append(first, len(values))))
        parts = np.split(code, np.cumsum([len(x) for x in lists])[:-1])
        return pa.table(
            {"block": table["block"], "owner": table["owner"], "codes": pa.array([p.tobytes() for p in parts], pa.binary())}
        )

    return answer


def _segments(w: Windows, codes: pa.Table) -> tuple[np.ndarray, ...]:
    """Segments whose anchor occurs twice: starts, sizes in bytes, keys; those of hot anchors cut to windows."""
    order = np.argsort(codes["owner"].to_numpy(), kind="stable")
    cells = codes["codes"].to_pylist()
    code = np.frombuffer(b"".join([cells[i] for i in order]), np.uint8)
    of = code[np.searchsorted(w.values, w.anchors)] if len(w.anchors) else np.zeros(0, np.uint8)
    n = w.ends - w.starts
    one = of == 1
    single = ranges(w.starts[of == 2], n[of == 2])
    starts = np.concatenate([w.starts[one], single])
    sizes = np.concatenate([n[one], np.ones(len(single), np.int64)]) + WINDOW - 1
    keys = w.anchors[one]
    if len(single):
        keys = np.concatenate([keys, spans_hashed(w.buf, single, single + WINDOW)])
    return starts, sizes, keys


def _distinct(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray):
    """Equal segments once: (first of each, number of each, which of them each segment is)."""
    marks = spans_hashed(buf, starts, starts + sizes) ^ mixed(keys)
    _, first, back, n = np.unique(marks, return_index=True, return_inverse=True, return_counts=True)
    return first, n, back


def _cells(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """buf[start:start + size] of each range as a binary column."""
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    held = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(buf[ranges(starts, sizes)]))]
    )
    return held.cast(pa.binary())


def _bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The cells of a binary column, one after the other, and their sizes."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    held = pa.concat_arrays(column.cast(pa.large_binary()).chunks)
    _, edges, data = held.buffers()
    edges = np.frombuffer(edges, np.int64)[held.offset : held.offset + len(held) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[edges[0] : edges[-1]], np.diff(edges)


_DEALT = pa.schema(
    [("block", pa.int64()), ("shard", pa.int64()), ("key", pa.int64()), ("copies", pa.int32()), ("number", pa.int32()), ("bytes", pa.binary())]
)


def _deal(n_shards: int):
    """Each distinct segment of a block is a row, so there are as many rows as segments, whatever the number of shards."""

    def deal(rows: pa.Table, codes: pa.Table) -> pa.Table:
        out = []
        for block, sizes_, blob in zip(*(rows[c].to_pylist() for c in ("block", "sizes", "blob")), strict=True):
            w = Windows(sizes_, blob)
            starts, sizes, keys = _segments(w, codes)
            first, n, _ = _distinct(w.buf, starts, sizes, keys)
            shards = packing.owners(keys[first], n_shards)
            for a, b in pieces(sizes[first].tolist(), PART):
                f = first[a:b]
                out.append(
                    pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(b - a, block, np.int64)), pa.array(shards[a:b]), pa.array(keys[f].view(np.int64)),
                            pa.array(n[a:b].astype(np.int32)), pa.array(np.arange(a, b, dtype=np.int32)), _cells(w.buf, starts[f], sizes[f]),
                        ],
                        schema=_DEALT,
                    )
                )
        return pa.Table.from_batches(out, _DEALT)

    return deal


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes, by Larsson-Sadakane refinement.

    Suffixes are sorted by 8 bytes. A group of equal ones is then sorted by the
    rank of what follows h bytes on, with h doubled each time; suffixes that are
    alone in their group are never looked at again.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    order = np.argsort(key)
    sorted_key = key[order]
    del key
    # Near the end of the text zero padding may tie with real zero bytes; ranks by position settle that.
    new = np.ones(n, bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(n + 1, np.int64)
    rank[n] = 0
    group = np.flatnonzero(new)
    rank[order] = np.repeat(group, np.diff(np.append(group, n))) + 1
    open_ = np.flatnonzero(~(new & np.append(new[1:], True)))
    h = 8
    while len(open_):
        suffix = order[open_]
        own = rank[suffix]
        follow = rank[np.minimum(suffix + h, n)]
        # A suffix that ends within h bytes goes before the longer ones.
        short = suffix + h > n
        follow[short] = -suffix[short] - 1
        # Ranks are at most n, and the negative ones of short suffixes at least -n.
        by = np.argsort(own * (2 * n + 2) + follow + n)
        suffix, own, follow = suffix[by], own[by], follow[by]
        order[open_] = suffix
        new = np.ones(len(open_), bool)
        new[1:] = (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])
        lead = np.flatnonzero(new)
        rank[suffix] = np.repeat(open_[lead], np.diff(np.append(lead, len(open_)))) + 1
        open_ = open_[~(new & np.append(new[1:], True))]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, least: int = 0) -> np.ndarray:
    """For each suffix in order, the bytes it shares with the one before; the first has 0.

    Numbers under `least` may come out too small, which saves looking at single bytes.

    In text order a suffix whose preceding byte equals that before its neighbour
    has its predecessor's length less one. Only the others are compared.
    """
    n = len(text)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    here = np.arange(n)
    heir = (before > 0) & (here > 0)
    heir[heir] = text[here[heir] - 1] == text[before[heir] - 1]
    roots = np.flatnonzero(~heir)
    length = np.zeros(len(roots), np.int64)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.zeros(n + 1, np.uint64)
    for i in range(8):
        words[:n] = (words[:n] << np.uint64(8)) | padded[i : i + n]
    other = before[roots]
    room = n - np.maximum(roots, other)
    live = np.flatnonzero(other >= 0)
    while len(live):
        live = live[room[live] - length[live] >= 8]
        live = live[words[roots[live] + length[live]] == words[other[live] + length[live]]]
        length[live] += 8
    live = np.flatnonzero((other >= 0) & (length + 7 >= least))
    for _ in range(7):
        live = live[room[live] > length[live]]
        live = live[text[roots[live] + length[live]] == text[other[live] + length[live]]]
        length[live] += 1
    last = np.maximum.accumulate(np.where(heir, 0, here))
    by_place = np.zeros(n, np.int64)
    by_place[roots] = length
    return np.maximum(by_place[last] - (here - last), 0)[order]


def repeated_windows(texts: np.ndarray, sizes: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """For each window start of each distinct segment, whether its 200 bytes occur twice in all."""
    order = suffix_array(texts)
    shared = common_prefixes(texts, order, WINDOW)
    kind = np.empty(len(texts), np.int64)
    kind[order] = np.cumsum(shared < WINDOW)
    starts = np.cumsum(sizes) - sizes
    n = sizes - WINDOW + 1
    at = kind[ranges(starts, n)]
    return np.bincount(at, np.repeat(copies, n))[at] > 1


def _octets(n: np.ndarray) -> np.ndarray:
    """Bytes that hold a bit for each of n windows."""
    return -(-n // 8)


def _judge(table: pa.Table) -> pa.Table:
    """A bit for each window of each segment, whether it occurs twice anywhere."""
    keys = table["key"].to_numpy().view(np.uint64)
    copies = table["copies"].to_numpy()
    buf, size = _bytes(table["bytes"])
    starts = np.cumsum(size) - size
    first, _, back = _distinct(buf, starts, size, keys)
    weight = np.bincount(back, copies).astype(np.int64)
    # All windows of a segment with two copies occur twice. What is left to find out is which windows of
    # segments with one copy occur in others of their anchor.
    windows = size[first] - WINDOW + 1
    octets = _octets(windows)
    at = np.cumsum(octets) - octets
    flags = np.ones(8 * int(octets.sum()), bool)
    order = np.argsort(keys[first], kind="stable")
    group = np.cumsum(np.diff(keys[first][order], prepend=~keys[first][order[:1]]) != 0) - 1
    lone = np.bincount(group, weight[order] == 1) > 0
    order, group = order[lone[group]], group[lone[group]]
    total, a = 0, 0
    for i, f in enumerate(order.tolist()):
        total += size[first[f]]
        if i + 1 == len(order) or (total >= SHARD and group[i + 1] != group[i]):
            part = order[a : i + 1]
            s = size[first[part]]
            flags[ranges(8 * at[part], windows[part])] = repeated_windows(buf[ranges(starts[first[part]], s)], s, weight[part])
            total, a = 0, i + 1
    return pa.table({"block": table["block"], "number": table["number"], "bits": _cells(np.packbits(flags), at[back], octets[back])})


def _remove(keep_text: bool):
    def remove(rows: pa.Table, more: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for ids, sizes_, blob in zip(*(rows[c].to_pylist() for c in ("ids", "sizes", "blob")), strict=True):
            w = Windows(sizes_, blob)
            lacking = pc.is_valid(more["codes"])
            starts, sizes, keys = _segments(w, more.filter(lacking))
            first, _, back = _distinct(w.buf, starts, sizes, keys)
            verdicts = more.filter(pc.invert(lacking))
            verdicts = verdicts.take(np.argsort(verdicts["number"].to_numpy(), kind="stable"))  # one per distinct segment
            n = sizes - WINDOW + 1
            flags = np.unpackbits(_bytes(verdicts["bits"])[0]).astype(bool)
            octets = _octets(n[first])
            at = 8 * (np.cumsum(octets) - octets)
            cover = np.zeros(len(w.buf) + 1, np.int32)
            if len(first):
                hit = ranges(starts, n)[flags[ranges(at[back], n)]]
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + WINDOW, -1)
            gone = np.cumsum(cover[:-1]) > 0
            fresh = gone.copy()
            fresh[1:] &= ~gone[:-1]
            fresh[w.edges[:-1][w.edges[:-1] < len(gone)]] |= gone[w.edges[:-1][w.edges[:-1] < len(gone)]]
            removed, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, fresh))
            kept = w.buf[~gone].tobytes()
            out["id"].extend(ids)
            for a, b in zip(w.edges[:-1].tolist(), w.edges[1:].tolist(), strict=True):
                text = kept[a - removed[a] : b - removed[b]]
                out["n_bytes"].append(b - a), out["n_removed"].append(int(removed[b] - removed[a]))
                out["n_spans"].append(int(spans[b] - spans[a]))
                out["kept_sha256"].append(hashlib.sha256(text).hexdigest()), out["kept"].append(text if keep_text else None)
        kinds = [rows.schema.field("ids").type.value_type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds, strict=True)})

    return remove


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, hot: int = HOT
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 and, with `keep_text`, kept (bytes).

    A byte goes when a string of 200 bytes covers it that also starts at another
    place, of any document or the same. Texts are UTF-8; null is empty; texts
    under 200 bytes are never touched. Rows that repeat an id are documents of
    their own. An empty table gives no rows; other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    blocks = packing.packed(docs, id_col, text_col)
    n_blocks = blocks.count()
    n_owners, n_shards = max(1, n_blocks // 16), 2 * n_blocks
    told = blocks.mapInArrow(_tell(n_owners), "block long, owner long, hashes binary, counts binary")
    codes = written(told.groupBy("owner").applyInArrow(_answer(hot), "block long, owner long, codes binary"), "codes")
    texts = blocks.select("block", "sizes", "blob")
    dealt = texts.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(
        _deal(n_shards), "block long, shard long, key long, copies int, number int, bytes binary"
    )
    judged = dealt.groupBy("shard").applyInArrow(_judge, "block long, number int, bits binary")
    none = F.lit(None)
    news = codes.select("block", "owner", "codes", none.cast("int").alias("number"), none.cast("binary").alias("bits")).unionByName(
        judged.select("block", none.cast("long").alias("owner"), none.cast("binary").alias("codes"), "number", "bits")
    )
    out = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    rows = blocks.groupBy("block").cogroup(news.groupBy("block")).applyInArrow(_remove(keep_text), out)
    return (rows if keep_text else rows.drop("kept")).withColumnRenamed("id", id_col)
