"""SentencePiece encoding and decoding of byte-pair models by vectorised merge rounds.

A text becomes symbols, one per character. In each round every word looks for
the best-ranked pair of neighbouring symbols and merges it, all words at once on
flat arrays, until no pair of any word is a piece. Where no merge that the new
symbol could join ranks before it, all its places in the word merge in the same
round, the leftmost first; otherwise only the leftmost, so that the result is
that of one merge at a time.

A text is cut only where no piece reaches across, and each distinct part is
encoded once as long as a worker remembers it; two hashes tell parts apart.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import bytes_of, pieces, slices, whole
from feedmill.llm.flat import joined, ranges
from feedmill.llm.parts import Remembered

SPACE = "▁"
#: Distinct parts that a worker remembers between batches.
REMEMBERED = 300_000
#: Bytes of text whose parts are encoded together.
TOGETHER = 1 << 20
NONE = np.int32(2**31 - 1)
#: Odd factor of the hash tables; the next table takes its next power.
MULTIPLIER = 0x9E3779B97F4A7C15


class Pieces:
    """Vocabulary and merge ranks of a SentencePiece BPE model with byte fallback and no normalisation."""

    def __init__(self, model: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=model)
        n = lib.vocab_size()
        names = [lib.id_to_piece(i) for i in range(n)]
        special = [lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) for i in range(n)]
        if any(lib.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        if lib.decode(lib.encode("  Ａb ")) != "  Ａb ":
            raise ValueError("only models without normalisation, with a space put first, are supported")
        ids = {names[i]: i for i in range(n) if not special[i]}
        self.byte_ids = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        score = np.array([lib.get_score(i) for i in range(n)])
        order = np.unique(-score, return_inverse=True)[1].astype(np.int32)  # equal scores share a rank
        # Characters without a piece of their own get numbers after the vocabulary.
        self.chars: dict[str, int] = {p: i for p, i in ids.items() if len(p) == 1}
        self.n = n
        lefts, rights, merged = [], [], []
        extra = set()
        for p, i in ids.items():
            for cut in range(1, len(p)):
                a, b = p[:cut], p[cut:]
                if (a in ids or cut == 1) and (b in ids or len(b) == 1):
                    for c in (a, b):
                        if len(c) == 1 and c not in self.chars:
                            extra.add(c)
        for c in sorted(extra):
            self.chars[c] = n + len(self.chars)
        symbol = lambda s: ids.get(s, self.chars.get(s, -1))
        for p, i in ids.items():
            for cut in range(1, len(p)):
                a, b = symbol(p[:cut]), symbol(p[cut:])
                if a >= 0 and b >= 0:
                    lefts.append(a), rights.append(b), merged.append(i)
        self.width = max([n, *self.chars.values()]) + 2
        self.other = self.width - 1  # any character that no piece has
        key = np.array(lefts, np.int64) * self.width + np.array(rights, np.int64)
        sort = np.argsort(key)
        self.keys, self.to = key[sort], np.array(merged, np.int32)[sort]
        self.rank = order
        self._hash()
        # The best rank of any merge that a symbol can be part of.
        best = np.full(self.width, NONE)
        for side in (lefts, rights):
            np.minimum.at(best, np.array(side, np.int64), order[np.array(merged, np.int64)])
        twins = np.bincount(order, minlength=int(order.max()) + 1)[order]
        self.together = (best[:n] > order) & (twins == 1)
        names = [bytes([int(x[3:5], 16)]) if lib.is_byte(i) else x.replace(SPACE, " ").encode() for i, x in enumerate(names)]
        for i in range(n):
            if lib.is_control(i) or lib.is_unknown(i):
                names[i] = b"" if lib.is_control(i) else " \u2047 ".encode()
        self.names = np.frombuffer(b"".join(names), np.uint8)
        self.name_size = np.array([len(x) for x in names])
        self.name_start = np.cumsum(self.name_size) - self.name_size
        digits = [b",%d" % i for i in range(n)]
        self.digits = np.array(digits).view(np.uint8).reshape(n, -1)  # padded with zero bytes
        self.digit_size = np.array([len(x) for x in digits])
        inner = {a + b for p in ids for a, b in zip(p, p[1:], strict=False)}
        if any(x[1] == SPACE != x[0] or "\n" in x for x in inner):
            raise ValueError("pieces that reach over the start of a word or a line feed are not supported")
        self.parts = Remembered(REMEMBERED)

    def _hash(self) -> None:
        """Tables of pair keys, each with those that found their place in the ones before taken."""
        self.bits = max(10, int(len(self.keys) * 6).bit_length())
        self.tables = []
        left, factor = np.arange(len(self.keys), dtype=np.int32), MULTIPLIER
        while len(left):
            table = np.full(1 << self.bits, -1, np.int32)
            at = self._slots(self.keys[left], factor)
            table[at] = left
            left = left[table[at] != left]
            self.tables.append((factor, table))
            factor = factor * MULTIPLIER % 2**64

    def _slots(self, key: np.ndarray, factor: int) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(factor)) >> np.uint64(64 - self.bits)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece that each pair merges to and its rank; rank NONE where there is none."""
        key = left.astype(np.int64) * self.width + right
        at = np.full(len(key), -1, np.int32)
        open_ = np.arange(len(key))
        for factor, table in self.tables:  # an empty place ends the search
            found = table[self._slots(key[open_], factor)]
            taken = found >= 0
            open_, found = open_[taken], found[taken]
            same = self.keys[found] == key[open_]
            at[open_[same]] = found[same]
            open_ = open_[~same]
        to = self.to[at]
        rank = np.where(at < 0, NONE, self.rank[to])
        return to, rank

    def encode_parts(self, chars: str, owner: np.ndarray, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the parts that the characters belong to, and how many each part has."""
        points = np.frombuffer(chars.encode("utf-32-le"), np.uint32)
        kinds, back = np.unique(points, return_inverse=True)
        symbols = np.array([self.chars.get(chr(c), self.other) for c in kinds], np.int32)[back]
        owner = owner.astype(np.int32)
        first = np.arange(len(points), dtype=np.int32)  # the character a symbol starts with
        done_symbols, done_owner, done_first = [], [], []
        apart = np.flatnonzero(np.diff(owner))  # pairs across two words
        to, rank = self._pairs(symbols[:-1], symbols[1:])
        rank[apart] = NONE
        to, rank = np.append(to, np.int32(0)), np.append(rank, NONE)
        while len(symbols):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            length = np.diff(np.append(starts, len(owner)))
            best_of = np.repeat(best, length)
            if (best == NONE).any():  # finished words leave
                over = np.flatnonzero(best_of == NONE)
                done_symbols.append(symbols[over]), done_owner.append(owner[over]), done_first.append(first[over])
                stay = np.flatnonzero(best_of != NONE)
                symbols, owner, first, best_of, to, rank = (x[stay] for x in (symbols, owner, first, best_of, to, rank))
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == best_of)
            # Without leave to merge together, only the first hit of a word counts.
            leftmost = np.diff(owner[hits], prepend=-1) != 0
            hits = hits[self.together[to[hits]] | leftmost]
            # Of overlapping hits (x x x) every other one, from the left.
            run = np.flatnonzero(np.diff(hits, prepend=-9) != 1)
            offset = np.arange(len(hits)) - np.repeat(run, np.diff(np.append(run, len(hits))))
            hits = hits[offset % 2 == 0]
            symbols[hits] = to[hits]
            stay = np.ones(len(symbols), bool)
            stay[hits + 1] = False
            stay = np.flatnonzero(stay)
            symbols, owner, first, to, rank = (x[stay] for x in (symbols, owner, first, to, rank))
            # Only pairs at the new symbols have changed.
            at = hits - np.arange(len(hits))
            at = np.concatenate([at, at[at > 0] - 1])
            follow = np.minimum(at + 1, len(symbols) - 1)
            to[at], rank[at] = self._pairs(symbols[at], symbols[follow])
            rank[at[(owner[at] != owner[follow]) | (follow == at)]] = NONE
        if not done_symbols:
            return np.zeros(0, np.int64), np.zeros(n_parts, np.int64)
        symbols, owner, first = (np.concatenate(x) for x in (done_symbols, done_owner, done_first))
        placed, owners = np.full(len(points), -1), np.empty(len(points), np.int64)  # in the order of their first characters
        placed[first], owners[first] = symbols, owner
        first = np.flatnonzero(placed >= 0)
        return self._fall_back(placed[first], owners[first], points[first], n_parts)

    def _fall_back(self, symbols, owner, points, n_parts):
        """Symbols without an id become the ids of their UTF-8 bytes."""
        unknown = np.flatnonzero(symbols >= self.n)
        if len(unknown):
            codes = [chr(c).encode() for c in points[unknown]]
            times = np.ones(len(symbols), np.int64)
            times[unknown] = [len(c) for c in codes]
            ids = np.repeat(symbols, times)
            ids[np.repeat(symbols >= self.n, times)] = self.byte_ids[np.frombuffer(b"".join(codes), np.uint8)]
            symbols, owner = ids, np.repeat(owner, times)
        return symbols, np.bincount(owner, minlength=n_parts)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (UTF-8), one after the other, and how many each has."""
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        buf, edges = joined([b" " + t.replace(SPACE.encode(), b" ") if t else t for t in texts])
        space, line = buf == 32, buf == 10
        start = line.copy()
        start[1:] |= line[:-1] | (space[1:] & ~space[:-1])
        start[0] = True
        ends_text = edges[1:] - 1  # the line feed after a text is none of it
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(buf))
        stay = ~np.isin(starts, ends_text, assume_unique=True)
        starts, ends = starts[stay], ends[stay]
        ids, size = self.encode_spans(buf, starts, ends)
        total = np.concatenate([[0], np.cumsum(size)])
        return ids, np.diff(total[np.searchsorted(starts, edges)])

    def encode_spans(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of spans of bytes that no piece reaches across, and how many each has."""

        def fresh(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            n = ends - starts
            raw = buf[ranges(starts, n)]
            owner = np.repeat(np.arange(len(n)), n)[(raw & 0xC0) != 0x80]
            return self.encode_parts(raw.tobytes().decode().replace(" ", SPACE), owner, len(n))

        return self.parts.ids(buf, starts, ends, fresh)

    def decimals(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The ids of each text as decimals with commas between them."""
        digits = self.digits[ids].ravel()
        raw = digits[digits != 0].tobytes()
        ends = np.concatenate([[0], np.cumsum(self.digit_size[ids])])[np.cumsum(sizes)].tolist()
        return [raw[a + 1 : b] for a, b in zip([0, *ends], ends, strict=False)]

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The text that the ids of each text stand for: bytes in a row are read as UTF-8, the first space goes."""
        raw = self.names[ranges(self.name_start[ids], self.name_size[ids])].tobytes()
        ends = np.concatenate([[0], np.cumsum(self.name_size[ids])])[np.cumsum(sizes)].tolist()
        return [_legible(raw[a + (raw[a : a + 1] == b" " and a < b) : b]) for a, b in zip([0, *ends], ends, strict=False)]


def _legible(text: bytes) -> bytes:
    """Valid UTF-8; each byte that can't be read becomes one replacement character."""
    try:
        text.decode()
        return text
    except UnicodeDecodeError:
        out = text.decode("utf-8", "surrogateescape")
        return "".join("\ufffd" if "\udc80" <= c <= "\udcff" else c for c in out).encode()


@lru_cache(maxsize=2)
def load(model: str) -> Pieces:
    return Pieces(model)


def _encoder(model: str, digests: bool):
    def encode(batches):
        tool = load(model)
        for batch in slices(batches):
            texts = bytes_of(batch["text"])
            columns: list[list] = [[], [], []]
            for a, b in pieces([len(t) for t in texts], TOGETHER):
                ids, sizes = tool.encode(texts[a:b])
                decoded = tool.decode(ids, sizes)
                columns[0].extend(sizes.tolist())
                if digests:
                    columns[1].extend(hashlib.sha256(x).hexdigest() for x in tool.decimals(ids, sizes))
                    columns[2].extend(hashlib.sha256(x).hexdigest() for x in decoded)
                else:
                    columns[1].extend(np.split(ids.astype(np.int32), np.cumsum(sizes)[:-1]))
                    columns[2].extend(x.decode() for x in decoded)
            kinds = [pa.int64(), pa.string() if digests else pa.list_(pa.int32()), pa.string()]
            names = [*batch.schema.names[:-1], "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
            arrays = [*batch.columns[:-1], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return encode


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, ids and decoded; with `digests`, their SHA-256 instead.

    `model` is the path of a SentencePiece BPE model, the same on every executor.
    No begin or end ids. Null texts are empty and have no ids. The digest of ids
    is over the decimal numbers joined by commas. Other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    out = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    return rows.mapInArrow(_encoder(model, digests), f"id {kind}, n_tokens long, {out}").withColumnRenamed("id", id_col)


def _decoder(model: str):
    def decode(batches):
        tool = load(model)
        for batch in batches:
            rows = [np.array(x or [], np.int64) for x in batch["ids"].to_pylist()]
            texts = tool.decode(np.concatenate([*rows, np.zeros(0, np.int64)]), np.array([len(x) for x in rows], np.int64))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array([t.decode() for t in texts], pa.string())], ["id", "text"])

    return decode


def decode_pieces(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and text of rows of ids; null or no ids give an empty text."""
    kind = dict(encoded.dtypes)[id_col]
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decoder(model), f"id {kind}, text string").withColumnRenamed("id", id_col)
