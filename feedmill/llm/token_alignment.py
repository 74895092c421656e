"""Alignment of two tokenizers, and how often their ids meet, as an Arrow pipeline.

Both tokenizers cut the same bytes, a space and then the text. In a batch:

1. The ids of all texts are list columns. Flattened, with the number of its text as
   parent of every id, they take the sizes of their tokens from a table of the
   vocabulary; cumulative sums, less the sum where the text starts, are the ends of tokens.
2. An Acero hash join of the two tables of (text, end) finds the ends that both have:
   they cut the text into groups. A full outer join gives all ends. Between two
   neighbouring ends lies one piece of one token of either kind: a link.
3. `Table.group_by` counts the pairs of ids of a chunk of texts. Spark adds the
   counts of all chunks up.

The links of a chunk are kept as numbers of its distinct pairs. When the corpus's
counts are known they come back to the chunk by its pairs, not by its links.
"""

from __future__ import annotations

import base64
import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import bytes_of, pieces, slices, whole, written
from feedmill.llm.flat import ranges
from feedmill.llm.sentence_pieces import load as load_pieces

#: Bytes of text that are encoded at a time, that are joined at a time, and of a chunk, whose pairs are counted together.
ENCODED = 1 << 20
JOINED = 1 << 18
CHUNK = 1 << 23
#: An id of the first kind is multiplied by this before one of the second kind is added.
PAIR = 1 << 32
#: Ids are below this; their decimals, padded with zero bytes.
MOST_IDS = 1 << 17
DIGITS = np.array([b"%d" % i for i in range(MOST_IDS)], "S8").view("<u8")
DIGIT_COUNT = np.array([len(str(i)) for i in range(MOST_IDS)])


class ByteTokens:
    """A byte-level BPE tokenizer. Its tokens are all bytes there are, so they always give the text back."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        if max(ranks.values()) >= MOST_IDS:
            raise ValueError(f"vocabularies of more than {MOST_IDS} ids are not supported")
        self._tool = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.sizes[i] = len(token)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in UTF-8, one after the other, and how many each has."""
        lists = pa.array([self._tool.encode_ordinary(t.decode()) for t in texts], pa.list_(pa.int32()))
        return lists.values.to_numpy().astype(np.int64), np.diff(lists.offsets.to_numpy().astype(np.int64))


@lru_cache(maxsize=2)
def load_bytes(ranks_path: str, pattern: str) -> ByteTokens:
    return ByteTokens(ranks_path, pattern)


def check_same_ids(json_path: str, ranks_path: str) -> None:
    """The two files of the first vocabulary must tell the same ids; called once, on the driver."""
    with open(json_path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    letters = byte_letters()
    if any(vocabulary.get("".join(letters[b] for b in token)) != i for token, i in ranks.items()):
        raise ValueError("the two files of the byte-level vocabulary disagree")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


#: A token's place: the number of its text times this, and the byte of the text at which it ends.
TEXT = np.int64(1 << 40)


def _ends(lists: pa.ListArray, sizes: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """The tokens before each text, the bytes before it, and (place, row) of the flattened tokens."""
    ids, text = lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    running = pc.cumulative_sum(sizes.take(ids)).to_numpy(zero_copy_only=False)
    edges = lists.offsets.to_numpy().astype(np.int64)
    before = np.concatenate([[0], running])[edges]
    place = running + (np.arange(len(lists), dtype=np.int64) * TEXT - before[:-1])[text]
    return edges, before, pa.table({"place": place, "row": pa.array(np.arange(len(place), dtype=np.int32))})


def _digests(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, text_of_group: np.ndarray, n_texts: int) -> list[str]:
    """SHA-256 of a1,a2|b1;a3|b2,b3 of each text; a text without groups has none."""
    n = len(text_of_group)
    count_a, count_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    # Where tokens stand: the first kind of a group, then the second.
    at_a = np.arange(len(a)) + (np.cumsum(count_b) - count_b)[group_a]
    at_b = np.arange(len(b)) + np.cumsum(count_a)[group_b]
    ids = np.empty(len(a) + len(b), np.int64)
    ids[at_a], ids[at_b] = a, b
    sign = np.full(len(ids), ord(","), np.uint64)
    sign[at_a[np.cumsum(count_a) - 1]] = ord("|")
    sign[at_b[np.cumsum(count_b) - 1]] = ord(";")
    size = DIGIT_COUNT[ids]
    raw = (DIGITS[ids] | (sign << (8 * size).astype(np.uint64))).view(np.uint8)
    text = raw[raw != 0].tobytes()
    stops = np.cumsum(size + 1)[np.cumsum(count_a + count_b) - 1]  # the end of each group
    last = np.flatnonzero(np.diff(text_of_group, append=-1))
    out, start = [""] * n_texts, 0
    for k, stop in zip(text_of_group[last].tolist(), stops[last].tolist(), strict=True):
        out[k] = hashlib.sha256(text[start : stop - 1]).hexdigest()  # no sign after the last token
        start = stop
    return out


def align(a: pa.ListArray, b: pa.ListArray, sizes_a: pa.Array, sizes_b: pa.Array) -> tuple[pa.Table, pa.Table]:
    """The links (text, a, b) in order, and per text n_a, n_b, n_groups, n_links, groups_sha256.

    `a` and `b` are the ids of both kinds, of tokens that cover the same bytes of each text.
    """
    n_texts = len(a)
    edges_a, before, ends_a = _ends(a, sizes_a)
    edges_b, _, ends_b = _ends(b, sizes_b)
    every = ends_a.join(ends_b, "place", join_type="full outer", right_suffix="_b", use_threads=False)
    place = every["place"].to_numpy()
    text, end = place // TEXT, place % TEXT
    # The bytes of all texts stand in a row: a row of the join goes to the byte where it ends.
    at = np.full(int(before[-1]) + 1, -1, np.int32)
    at[before[text] + end] = np.arange(len(place), dtype=np.int32)
    order = at[at >= 0]
    row_a, row_b = (every[c].combine_chunks().take(pa.array(order)) for c in ("row", "row_b"))
    both = row_a.is_valid().to_numpy(zero_copy_only=False) & row_b.is_valid().to_numpy(zero_copy_only=False)
    # A piece belongs to the token that ends next; the last ends of a text are common.
    row_a, row_b = (pc.fill_null_backward(x).to_numpy() for x in (row_a, row_b))
    ids_a, ids_b = (x.flatten().to_numpy().astype(np.int64) for x in (a, b))
    text = text[order]
    links = pa.table({"text": text, "a": ids_a[row_a], "b": ids_b[row_b]})
    # The group of a link is the number of common ends before it, and a token's that of its links.
    group = np.cumsum(both) - both
    group_a, group_b = np.empty(len(ids_a), np.int64), np.empty(len(ids_b), np.int64)
    group_a[row_a], group_b[row_b] = group, group
    digests = _digests(ids_a, ids_b, group_a, group_b, text[both], n_texts)
    per_text = pa.table(
        {
            "n_a": np.diff(edges_a), "n_b": np.diff(edges_b),
            "n_groups": np.bincount(text[both], minlength=n_texts), "n_links": np.bincount(text, minlength=n_texts),
            "groups_sha256": digests,
        }
    )
    return links, per_text


class Tokenizers:
    """Both tokenizers of a worker."""

    def __init__(self, ranks_path: str, pattern: str, model: str):
        self.bytes, self.pieces = load_bytes(ranks_path, pattern), load_pieces(model)
        self.sizes_a, self.sizes_b = pa.array(self.bytes.sizes), pa.array(self.pieces.name_size)

    def lists(self, texts: list[bytes]) -> tuple[pa.ListArray, pa.ListArray]:
        """The ids of both kinds per text; texts that tokens don't give back byte by byte have none."""
        spaced = [b" " + t if t else b"" for t in texts]
        ids_a, n_a = self.bytes.encode(spaced)
        ids_b, n_b = self.pieces.encode(texts)
        size = np.array([len(t) for t in spaced])
        total_a, total_b = (np.concatenate([[0], np.cumsum(s[i])]) for s, i in ((self.bytes.sizes, ids_a), (self.pieces.name_size, ids_b)))
        edges_a, edges_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
        same = (np.diff(total_a[edges_a]) == size) & (np.diff(total_b[edges_b]) == size)
        joined = self.pieces.names[ranges(self.pieces.name_start[ids_b], self.pieces.name_size[ids_b])].tobytes()
        if joined != b"".join(spaced):  # look at each text
            starts = total_b[edges_b].tolist()
            for i in np.flatnonzero(same).tolist():
                same[i] = joined[starts[i] : starts[i + 1]] == spaced[i]
        out = []
        for ids, n in ((ids_a, n_a), (ids_b, n_b)):
            kept = ids if same.all() else ids[np.repeat(same, n)]
            offsets = np.concatenate([[0], np.cumsum(np.where(same, n, 0))]).astype(np.int32)
            out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(kept.astype(np.int32))))
        return out[0], out[1]


@lru_cache(maxsize=1)
def _tokenizers(ranks_path: str, pattern: str, model: str) -> Tokenizers:
    return Tokenizers(ranks_path, pattern, model)


class _Chunk:
    """Texts whose pairs are counted together."""

    def __init__(self):
        self.ids, self.texts, self.pairs, self.counts, self.bytes = [], [], [], [], 0

    def add(self, ids: list, links: pa.Table, per_text: pa.Table, size: int) -> None:
        codes = links["a"].to_numpy() * PAIR + links["b"].to_numpy()
        counted = pa.table({"pair": codes}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
        self.counts.append(counted.rename_columns(["pair", "n"]))
        self.ids.extend(ids), self.texts.append(per_text), self.pairs.append(codes)
        self.bytes += size

    def row(self, number: int, kind: pa.DataType) -> pa.RecordBatch:
        """One row: texts with their figures, distinct pairs with their counts, links as numbers of pairs."""
        squeeze = zstandard.ZstdCompressor(level=1)
        counts = pa.concat_tables(self.counts).group_by("pair", use_threads=False).aggregate([("n", "sum")])
        counts = counts.rename_columns(["pair", "n"]).sort_by("pair")
        pairs = counts["pair"].to_numpy()
        links = pc.index_in(pa.array(np.concatenate(self.pairs)), counts["pair"].combine_chunks()).to_numpy()
        texts = pa.concat_tables(self.texts)
        figures = {c: pa.array([texts[c].to_pylist()], pa.list_(k)) for c, k in (*FIGURES, ("groups_sha256", pa.string()))}
        return pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array([number], pa.int64()), "ids": pa.array([self.ids], pa.list_(kind)), **figures,
                "pairs": pa.array([pairs.tolist()], pa.list_(pa.int64())), "counts": pa.array([counts["n"].to_pylist()], pa.list_(pa.int64())),
                "links": pa.array([squeeze.compress(links.tobytes())], pa.binary()),
            }
        )


FIGURES = (("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()))


def _part(lists: pa.ListArray, start: int, stop: int) -> pa.ListArray:
    """Some neighbouring lists, their values from 0 on."""
    offsets = lists.offsets.to_numpy()[start : stop + 1]
    values = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    return pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), values)


def _aligned(ranks_path: str, pattern: str, model: str):
    def aligned(batches):
        tools = _tokenizers(ranks_path, pattern, model)
        first, n, chunk, kind = TaskContext.get().partitionId() << 32, 0, _Chunk(), None
        for batch in slices(batches):
            kind = batch["id"].type
            ids, texts = batch["id"].to_pylist(), bytes_of(batch["text"])
            for start, stop in pieces([len(t) for t in texts], ENCODED):
                a, b = tools.lists(texts[start:stop])
                for i, j in pieces([len(t) for t in texts[start:stop]], JOINED):
                    links, per_text = align(_part(a, i, j), _part(b, i, j), tools.sizes_a, tools.sizes_b)
                    chunk.add(ids[start + i : start + j], links, per_text, sum(map(len, texts[start + i : start + j])))
                if chunk.bytes >= CHUNK:
                    yield chunk.row(first + n, kind)
                    n, chunk = n + 1, _Chunk()
        if chunk.ids:
            yield chunk.row(first + n, kind)

    return aligned


def _told(batches):
    """(chunk, pair, n) of the chunks, some thousand rows at a time."""
    for batch in batches:
        for chunk, pairs, counts in zip(batch["chunk"].to_pylist(), batch["pairs"], batch["counts"], strict=True):
            for at in range(0, len(pairs), 1 << 16):
                part = pairs.values.slice(at, 1 << 16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(part), pa.int64()), part, counts.values.slice(at, 1 << 16)], ["chunk", "pair", "n"]
                )


def _scored(kind: pa.DataType):
    """What the corpus's counts make of the texts of a chunk."""

    def scored(chunks: pa.Table, told: pa.Table) -> pa.Table:
        order = pc.sort_indices(told["pair"])
        total, best = told["total"].take(order).to_numpy(), told["best"].take(order).to_numpy(zero_copy_only=False)
        out = []
        for row in range(chunks.num_rows):
            ids = chunks["ids"][row].values
            figures = {c: chunks[c][row].values for c, _ in FIGURES}
            raw = zstandard.ZstdDecompressor().decompress(chunks["links"][row].as_py())
            links = np.frombuffer(raw, np.int32)
            edges = np.concatenate([[0], np.cumsum(figures["n_links"].to_numpy())])
            sums = [np.concatenate([[0], np.cumsum(x[links])]) for x in (best.astype(np.int64), total)]
            n_best, count_sum = (np.diff(s[edges]) for s in sums)
            out.append(
                pa.table(
                    {
                        "id": ids.cast(kind), **figures, "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()),
                        "groups_sha256": chunks["groups_sha256"][row].values,
                    }
                )
            )
        return pa.concat_tables(out)

    return scored


def chunks_of(docs: DataFrame, ranks_path: str, pattern: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table of aligned chunks: texts with their figures, distinct pairs, links."""
    kind = dict(docs.dtypes)[id_col]
    lists = ", ".join(f"{c} array<long>" for c, _ in FIGURES)
    schema = f"chunk long, ids array<{kind}>, {lists}, groups_sha256 array<string>, pairs array<long>, counts array<long>, links binary"
    source = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    return written(source.mapInArrow(_aligned(ranks_path, pattern, model), schema), "aligned")


def pair_counts(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunk, pair, n) of the chunks, and (pair, total, best) of the corpus."""
    told = chunks.select("chunk", "pairs", "counts").mapInArrow(_told, "chunk long, pair long, n long")
    total = written(told.groupBy("pair").agg(F.sum("n").alias("total")), "pairs")
    second = F.col("pair") % PAIR
    most = total.groupBy(second.alias("second")).agg(F.max("total").alias("most"))
    best = total.join(most, second == F.col("second")).select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    return told, best


def align_tokens(
    docs: DataFrame, ranks_path: str, pattern: str, model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `ranks_path` and `pattern` are a byte-level BPE vocabulary as ranks and the pattern
    of its words, `model` a SentencePiece BPE model; paths are the same on every executor.
    The first encodes a space and the text, the second the text, to which it adds the
    space; special tokens in texts are plain text. Null and empty texts, and those
    whose tokens don't give the bytes back, have no tokens: zeros and an empty digest.
    Texts are taken whole. Rows that repeat an id are documents of their own; an empty
    table gives no rows; other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    chunks = chunks_of(docs, ranks_path, pattern, model, id_col, text_col)
    told, best = pair_counts(chunks)
    known = told.select("chunk", "pair").join(best, "pair")
    figures = ", ".join(f"{c} long" for c, _ in FIGURES)
    texts = chunks.drop("pairs", "counts").groupBy("chunk").cogroup(known.groupBy("chunk"))
    scored = texts.applyInArrow(
        _scored(_kind_of(docs, id_col)), f"id {kind}, {figures}, n_best long, count_sum long, groups_sha256 string"
    )
    return scored.withColumnRenamed("id", id_col)


def _kind_of(docs: DataFrame, id_col: str) -> pa.DataType:
    from feedmill.llm.common import arrow_schema

    return arrow_schema(docs.select(id_col).schema).field(0).type
