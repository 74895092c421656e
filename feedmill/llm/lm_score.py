"""Language-model scores: a causal self-attention model on subword ids, with the corpus's word counts.

Word counts of all training documents are summed by owners of hash ranges. The
attention model reads subword ids: one masked attention over a window of ids
gives the mixing weights of a few expert distributions over all ids. It is
trained in numpy where the data lie: training texts give all their windows,
partitions train from the same start, and their weights are averaged, round by
round; a window is in one of the rounds. Long texts are scored in overlapping windows, each id once.

A word's probability is a mix of the model's and the add-one share of the word
in the corpus; the model's is that of its pieces and of a word's end after them,
so that both are distributions over words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import blocks as packing
from feedmill.llm import flat
from feedmill.llm.common import whole, written
from feedmill.llm.sentence_pieces import SPACE, load

BEGIN, END = 1, 2
#: Ids of a window, and ids by which the next window is further on.
WINDOW, STRIDE = 32, 24
#: Size of an embedding and number of expert distributions.
WIDTH, EXPERTS = 16, 16
ROUNDS, RATE = 4, 0.06
#: Training steps of a round at least: where windows are few, they come again.
STEPS = 60
#: Windows of one training step, and of what is worked out at a time, in a processor's cache, in training and scoring.
STEP, BATCH = 256, 64
#: Windows that a training task holds and shuffles at a time: `STEPS` steps or more.
POOL = 1 << 14
#: Weight of the attention model in the mix.
SHARE = 0.45
CHUNK = 1 << 16
FOLDS, HELD_OUT = 7, 2


def _keep_some_memory() -> None:
    """Steps ask for the same few megabytes again and again: so much stays with the worker."""
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt is not None:
        mallopt(-3, 8 << 20)  # M_MMAP_THRESHOLD
        mallopt(-1, 32 << 20)  # M_TRIM_THRESHOLD


_keep_some_memory()


class Words:
    """The lower-cased words of a block: positions and hashes, and which words each document has."""

    def __init__(self, sizes: bytes, blob: bytes):
        raw, edges = packing.unpacked(sizes, blob)
        texts = [raw[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        joined, at = flat.joined(texts)
        self.buf = flat.LOWER[joined]
        self.starts, self.ends = flat.words(self.buf)
        self.hashes = flat.spans_hashed(self.buf, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, at)
        self.values, self.back = np.unique(self.hashes, return_inverse=True)

    def spoken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct words, in the order of `values`, as the model reads them: bytes, starts and ends, each with a space first."""
        one = np.empty(len(self.values), np.int64)
        one[self.back] = np.arange(len(self.back))  # any place that a word has
        n = self.ends[one] - self.starts[one] + 1
        buf = self.buf[np.maximum(flat.ranges(self.starts[one] - 1, n), 0)]
        buf[np.cumsum(n) - n] = 32
        buf = np.frombuffer(buf.tobytes().replace(SPACE.encode(), b"_"), np.uint8)
        starts = np.flatnonzero(buf == 32)
        return buf, starts, np.append(starts[1:], len(buf))[: len(starts)]


def _held_out(ids: list) -> np.ndarray:
    from zlib import crc32

    return np.array([i is not None and crc32(str(i).encode()) % FOLDS == HELD_OUT for i in ids], bool)


_squeeze, _unsqueeze = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress


def small(x: np.ndarray) -> bytes:
    """Numbers of 0 or more in the fewest bytes that hold the largest, compressed."""
    x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
    return bytes([x.itemsize]) + _squeeze(x.tobytes())


def large(cell: bytes) -> np.ndarray:
    return np.frombuffer(_unsqueeze(cell[1:]), f"u{cell[0]}")


def steps(values: np.ndarray) -> bytes:
    """Rising hashes as their differences, byte by byte, compressed."""
    return _squeeze(np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes())


def risen(cell: bytes) -> np.ndarray:
    octets = np.frombuffer(_unsqueeze(cell), np.uint8).reshape(8, -1)
    return np.cumsum(octets.T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def _code(model: str):
    """Blocks of texts as numbers: ids of the distinct words, which of them come one after the other, and their counts.

    No piece reaches over the start of a word, so that a word has the same ids wherever it is.
    """

    def code(batches):
        tool = load(model)
        for batch in packing.pack(batches):
            for block, ids, sizes, blob in zip(*(batch[c].to_pylist() for c in ("block", "ids", "sizes", "blob")), strict=True):
                w = Words(sizes, blob)
                found, k = tool.encode_spans(*w.spoken())
                train = np.repeat(~_held_out(ids), np.diff(w.first))
                counts = np.bincount(w.back[train], minlength=len(w.values))
                row = {"n_words": np.diff(w.first), "back": w.back, "k": k, "pieces": found, "counts": counts}
                cells = {c: pa.array([small(x)], pa.binary()) for c, x in row.items()}
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([block], pa.int64()), "ids": pa.array([ids], batch.schema.field("ids").type),
                        **cells, "hashes": pa.array([steps(w.values)], pa.binary()),
                    }
                )

    return code


class Coded:
    """A block's texts as ids, made of those of its distinct words."""

    def __init__(self, n_words: bytes, back: bytes, k: bytes, pieces: bytes):
        self.n_words, self.back, self.k, self.pieces = (large(x) for x in (n_words, back, k, pieces))

    def flow(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the documents that are marked, one after the other, and how many each has."""
        back = self.back[np.repeat(docs, self.n_words)]
        k = self.k.astype(np.int64)
        starts, k = np.cumsum(k) - k, k[back]
        total = np.concatenate([[0], np.cumsum(k)])
        ends = np.concatenate([[0], np.cumsum(self.n_words[docs], dtype=np.int64)])
        return self.pieces[flat.ranges(starts[back], k)].astype(np.int32), np.diff(total[ends])


CODED = ("ids", "n_words", "back", "k", "pieces")


def _tell(n_owners: int):
    def tell(batches):
        for batch in batches:
            for block, hashes, counts in zip(*(batch[c].to_pylist() for c in ("block", "hashes", "counts")), strict=True):
                values, counts = risen(hashes), large(counts)
                cuts = packing.cuts(packing.owners(values, n_owners))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block] * len(cuts), pa.int64()), pa.array([o for o, _, _ in cuts], pa.int64()),
                        pa.array([steps(values[a:b]) for _, a, b in cuts], pa.binary()),
                        pa.array([small(counts[a:b]) for _, a, b in cuts], pa.binary()),
                    ],
                    ["block", "owner", "hashes", "counts"],
                )

    return tell


def _sum(table: pa.Table) -> pa.Table:
    """The corpus's count of each word that a block asks for; tokens and distinct words of the owner in its first row."""
    lists = [risen(x) for x in table["hashes"].to_pylist()]
    counts = np.concatenate([large(x) for x in table["counts"].to_pylist()]).astype(np.int64)
    values, back = np.unique(np.concatenate(lists), return_inverse=True)
    sums = np.bincount(back, counts, len(values)).astype(np.int64)
    parts = np.split(sums[back], np.cumsum([len(x) for x in lists])[:-1])
    none = [0] * (len(lists) - 1)
    return pa.table(
        {
            "block": table["block"], "owner": table["owner"], "counts": pa.array([small(p) for p in parts], pa.binary()),
            "tokens": pa.array([int(sums.sum()), *none], pa.int64()), "distinct": pa.array([int((sums > 0).sum()), *none], pa.int64()),
        }
    )


def _windows(batches):
    """All windows of ids of every training text, and which ids are in them how often. Each id, and the end, is a target once."""
    for batch in batches:
        for ids, *coded in zip(*(batch[c].to_pylist() for c in CODED), strict=True):
            found, k = Coded(*coded).flow(~_held_out(ids))
            n = k // WINDOW + 1
            last = np.cumsum(n) - 1
            starts, ends = (last - n + 1) * WINDOW, (last - n + 1) * WINDOW + k + 1
            flow = np.full(int(n.sum()) * WINDOW, -1, np.int32)
            flow[starts], flow[flat.ranges(starts + 1, k)] = BEGIN, found
            over = ends == (last + 1) * WINDOW  # the end is a target of the last window, in the column after its ids
            flow[ends[~over]] = END
            rows = np.empty((int(n.sum()), WINDOW + 1), np.int32)
            rows[:, :WINDOW] = flow.reshape(-1, WINDOW)
            rows[:-1, WINDOW] = rows[1:, 0]
            rows[last, WINDOW] = np.where(over, END, -1)
            times = np.bincount(np.append(found, np.repeat(END, len(k))))
            seen = np.flatnonzero(times)
            cells = {"windows": rows.tobytes(), "seen": small(seen), "times": small(times[seen])}
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(rows)], pa.int64()), **{c: pa.array([x], pa.binary()) for c, x in cells.items()}})


def shapes(n_ids: int) -> dict[str, tuple[int, ...]]:
    return {
        "embed": (n_ids, WIDTH), "place": (WINDOW, WIDTH), "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH),
        "value": (WIDTH, WIDTH), "mix": (WIDTH, EXPERTS), "bias": (EXPERTS,), "experts": (n_ids, EXPERTS),
    }


def unpack(vector: np.ndarray, n_ids: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(n_ids).items():
        n = int(np.prod(shape))
        out[name] = vector[at : at + n].reshape(shape)
        at += n
    return out


def initial(counts: np.ndarray, seed: int = 3) -> np.ndarray:
    """Random weights; experts start at the shares of the ids, each with noise of its own."""
    rng = np.random.default_rng(seed)
    parts = {n: rng.normal(0, 0.3 if len(s) == 2 else 0.0, s) for n, s in shapes(len(counts)).items()}
    share = np.log((counts + 0.2) / (counts + 0.2).sum())
    parts["experts"] = share[:, None] + rng.normal(0, 1.0, parts["experts"].shape)
    return np.concatenate([p.ravel() for p in parts.values()]).astype(np.float32)


MASK = np.tri(WINDOW, dtype=np.float32)
ONES = np.ones((max(WINDOW, WIDTH, EXPERTS), 1), np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis: a product with ones is faster than `sum` where the axis is short."""
    return x @ ONES[: x.shape[-1]]


def _bounded(x: np.ndarray) -> np.ndarray:
    """exp(x) in place; no exponent is beyond +-60, so none overflows."""
    if max(x.max(initial=0), -x.min(initial=0)) > 60:
        np.clip(x, -60, 60, out=x)
    return np.exp(x, out=x)


def _joint(p: dict) -> dict:
    """The weights with what attention needs of its matrices: queries by keys, values by the mix, the bias of a window's places."""
    if "across" in p:
        return p
    across = p["query"] @ p["key"].T * np.float32(WIDTH**-0.5)
    return p | {"across": across, "through": p["value"] @ p["mix"], "biases": np.tile(p["bias"], WINDOW)}


def forward(p: dict, x: np.ndarray, skip: int = 0, shares: bool = True) -> tuple:
    """Of windows of ids: embeddings, also turned, then, from place `skip` on, queries, attention, its sums, what it reads and expert weights.

    Queries meet embeddings: keys are part of the queries' matrix, values of the mix's. Attention is
    divided by its sums where it was read, so that all places of a window need not be. Without
    `shares`, the expert weights of a place are not divided by their sum.
    """
    p = _joint(p)
    e = np.take(p["embed"], x, axis=0)
    e += p["place"]
    turned = np.ascontiguousarray(e.transpose(0, 2, 1))
    own = e[:, skip:].reshape(-1, WIDTH)
    q = (own @ p["across"]).reshape(len(x), -1, WIDTH)
    a = _bounded(q @ turned)
    a *= MASK[skip:]
    total = _sums(a)
    u = a @ e
    u /= total
    z = u.reshape(-1, WIDTH) @ p["through"]
    z += own @ p["mix"]
    z = z.reshape(len(x), -1)
    z += p["biases"][skip * EXPERTS :]
    g = _bounded(z).reshape(len(x), -1, EXPERTS)
    if shares:
        g /= _sums(g)
    return e, turned, q, a, total, u, g


@lru_cache(maxsize=2)
def _pairs(n_ids: int, width: int) -> np.ndarray:
    """The places of the pairs of numbers of each row."""
    return np.arange(n_ids * width // 2).reshape(n_ids, -1)


def gradients(p: dict, experts: np.ndarray, rows: np.ndarray) -> dict[str, np.ndarray]:
    """Mean gradient of the log loss over the ids that are there; `experts`: each expert's share of each id."""
    x, y = np.maximum(rows[:, :-1], 0), np.maximum(rows[:, 1:], 0)
    there = rows[:, 1:] >= 0
    kind = p["embed"].dtype
    weight = (there / max(1, there.sum())).astype(kind)[:, :, None]
    n_ids, p = len(experts), _joint(p)
    # What goes to the rows of ids is gathered over all parts of the step.
    by_x, by_y = np.empty((*x.shape, WIDTH), kind), np.empty((*y.shape, EXPERTS), kind)
    d_across, d_through, d_mix, d_bias = (np.zeros(n, kind) for n in ((WIDTH, WIDTH), (WIDTH, EXPERTS), (WIDTH, EXPERTS), EXPERTS))
    for i in range(0, len(rows), BATCH):
        part = slice(i, i + BATCH)
        w = weight[part]
        e, turned, q, a, total, u, g = forward(p, x[part])
        rho = np.take(experts, y[part], axis=0, out=by_y[part], mode="clip")
        rho *= g
        rho *= w / np.maximum(_sums(rho), 1e-30)
        g *= w
        g -= rho
        dz = g.reshape(-1, EXPERTS)
        du = (dz @ p["through"].T).reshape(e.shape)
        du /= total
        ds = du @ turned
        ds -= _sums(du * u)
        ds *= a
        dq = (ds @ e).reshape(-1, WIDTH)
        de = by_x[part]
        np.matmul(ds.transpose(0, 2, 1), q, out=de)
        de += a.transpose(0, 2, 1) @ du
        de = de.reshape(-1, WIDTH)
        de += dq @ p["across"].T
        de += dz @ p["mix"].T
        e, u = e.reshape(-1, WIDTH), u.reshape(-1, WIDTH)
        d_across += e.T @ dq
        d_through += u.T @ dz
        d_mix += e.T @ dz
        d_bias += np.ones(len(dz), kind) @ dz
    d_across *= np.float32(WIDTH**-0.5)
    sums = {
        "query": d_across @ p["key"], "key": d_across.T @ p["query"], "value": d_through @ p["mix"].T,
        "mix": p["value"].T @ d_through + d_mix, "bias": d_bias,
    }

    # A row of ids takes its numbers two by two, as parts of a complex one: half as many places.
    pair = np.result_type(kind, np.complex64)
    places = _pairs(n_ids, WIDTH), _pairs(n_ids, EXPERTS)
    sums["place"], sums["embed"] = by_x.sum(axis=0), np.zeros((n_ids, WIDTH), kind)
    sums["experts"] = experts * (np.ones(y.size, kind) @ by_y.reshape(-1, EXPERTS))
    np.add.at(sums["embed"].reshape(-1).view(pair), np.take(places[0], x, axis=0).ravel(), by_x.reshape(-1).view(pair))
    np.subtract.at(sums["experts"].reshape(-1).view(pair), np.take(places[1], y, axis=0).ravel(), by_y.reshape(-1).view(pair))
    return sums


def train(vector: np.ndarray, pools: Iterable[np.ndarray], n_ids: int, seed: int) -> np.ndarray:
    """The weights after a pass over pools of windows of ids, and `STEPS` steps at least, by Adam."""
    vector = vector.copy()
    p = unpack(vector, n_ids)  # views
    mean, square, g, move = (np.zeros_like(vector) for _ in range(4))
    rng = np.random.default_rng(seed)
    step = 0
    for rows in pools:
        # Only a pool that is the first and last can be too short.
        times = 1 if step else -(-STEPS * STEP // max(1, len(rows)))
        order = np.concatenate([rng.permutation(len(rows)) for _ in range(max(1, times))])
        for at in range(0, len(order), STEP):
            step += 1
            experts = np.exp(p["experts"])  # of 30 at most
            experts /= np.ones(n_ids, np.float32) @ experts
            grads = gradients(p, experts, rows[order[at : at + STEP]])
            np.concatenate([grads[name].ravel() for name in shapes(n_ids)], out=g, casting="same_kind")
            # Adam's means, ten and a hundred times as large.
            mean *= np.float32(0.9)
            mean += g
            g *= g
            square *= np.float32(0.99)
            square += g
            scale = np.float32((0.01 / (1 - 0.99**step)) ** 0.5)
            np.sqrt(square, out=move)
            move += np.float32(1e-6) / scale
            np.divide(mean, move, out=move)
            move *= np.float32(0.1 * RATE / (1 - 0.9**step)) / scale
            vector -= move
            if max(vector.max(), -vector.min()) > 30:
                np.clip(vector, -30, 30, out=vector)
    return vector


def _pools(batches, compact: np.ndarray, round_: int) -> Iterator[np.ndarray]:
    """A round's windows of a partition, every window in one of the rounds, in arrays of `POOL` about."""
    parts, held, seen = [], 0, 0
    number = np.append(compact, -1).astype(np.int32)  # no id, -1, is the last one and stays
    for batch in batches:
        for i in range(batch.num_rows):
            rows = np.frombuffer(batch["windows"][i].as_py(), np.int32).reshape(-1, WINDOW + 1)
            mine = rows[(round_ - seen) % ROUNDS :: ROUNDS]
            seen += len(rows)
            if len(mine):
                parts.append(number[mine])
                held += len(mine)
            if held >= POOL:
                yield np.concatenate(parts)
                parts, held = [], 0
    if parts:
        yield np.concatenate(parts)


def _round(shared, round_: int):
    def one_round(batches):
        vector, compact = shared.value
        used = 0

        def counted():
            nonlocal used
            for rows in _pools(batches, compact, round_):
                used += len(rows)
                yield rows

        vector = train(vector, counted(), int(compact.max()) + 1, round_)
        if used:
            vector *= np.float32(used)
            cuts = range(0, len(vector), CHUNK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(cuts)), pa.int64()), pa.array([float(used)] * len(cuts)),
                    pa.array([vector[i : i + CHUNK].tobytes() for i in cuts], pa.binary()),
                ],
                ["chunk", "weight", "part"],
            )

    return one_round


def _average(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.float32).astype(float) for x in table["part"].to_pylist())
    mean = (total / pc.sum(table["weight"]).as_py()).astype(np.float32)
    return pa.table({"chunk": table["chunk"].slice(0, 1), "part": pa.array([mean.tobytes()], pa.binary())})


def trained(windows: DataFrame, n_ids: int) -> tuple[np.ndarray, np.ndarray]:
    """The averaged weights, of a size that the vocabulary bounds, and the model's number of each id.

    Ids that no training text has share the number 0.
    """
    spark = windows.sparkSession

    def ids_counted(batches):
        total = np.zeros(n_ids, np.int64)
        for batch in batches:
            for seen, times in zip(batch["seen"].to_pylist(), batch["times"].to_pylist(), strict=True):
                total[large(seen)] += large(times)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["i", "n"])

    known = np.zeros(n_ids)
    for r in windows.select("seen", "times").mapInArrow(ids_counted, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        known[r["i"]] = r["n"]  # a row per id of the vocabulary at most
    known[[BEGIN, END]] += 1
    compact = np.zeros(n_ids, np.int64)
    compact[known > 0] = np.arange(1, (known > 0).sum() + 1)
    vector = initial(np.concatenate([[1.0], known[known > 0]]))
    for i in range(ROUNDS):
        shared = spark.sparkContext.broadcast((vector, compact))
        sums = windows.select("windows").mapInArrow(_round(shared, i), "chunk long, weight double, part binary")
        parts = sums.groupBy("chunk").applyInArrow(_average, "chunk long, part binary").collect()
        if parts:
            vector = np.concatenate([np.frombuffer(r["part"], np.float32) for r in sorted(parts, key=lambda r: r["chunk"])])
    return vector, compact


class Scorer:
    def __init__(self, vector: np.ndarray, compact: np.ndarray, model: str):
        self.tool = load(model)
        self.compact = compact
        self.p = _joint(unpack(vector, int(compact.max()) + 1))
        self.experts = _softmax(self.p["experts"].T).T.astype(np.float32)
        first = self.tool.names[np.minimum(self.tool.name_start, len(self.tool.names) - 1)]
        self.opens = (first == 32) & (self.tool.name_size > 0)  # ids that begin a word
        self.opens[END] = True
        self.opens[[BEGIN, *self.tool.byte_ids]] = False
        # Ids without a number have equal parts of what is left for them.
        self.experts[0] /= max(1, (compact == 0).sum())
        # By these the sum of expert weights, and that of what begins a word.
        opening = self.experts[compact[self.opens]].sum(axis=0)
        self.sums = np.stack([np.ones_like(opening), opening], axis=1)

    def ids_logs(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log P of each id and of a word's begin in its place, for texts of ids that end with END.

        A text's later windows are asked for their last `STRIDE` places only: the others are what those look back on.
        """
        starts = np.cumsum(sizes) - sizes
        inputs = np.concatenate([[BEGIN], ids[:-1]])
        inputs[starts] = BEGIN
        more = np.maximum(0, -(-(sizes - WINDOW) // STRIDE))
        later = np.repeat(starts, more) + (flat.ranges(np.zeros_like(more), more) + 1) * STRIDE
        targets, inputs = self.compact[ids], self.compact[inputs]
        logs, opens = np.empty(len(ids), np.float32), np.empty(len(ids), np.float32)
        for base, stops, skip in ((starts, starts + sizes, 0), (later, np.repeat(starts + sizes, more), WINDOW - STRIDE)):
            for i in range(0, len(base), BATCH):
                at = base[i : i + BATCH, None] + np.arange(WINDOW)
                there = at[:, skip:] < stops[i : i + BATCH, None]
                np.minimum(at, len(ids) - 1, out=at)
                g = forward(self.p, np.take(inputs, at), skip, shares=False)[6]
                at = at[:, skip:]
                place = at[there]
                total, open_ = (g @ self.sums).transpose(2, 0, 1)
                opens[place] = np.log(open_ / total + 1e-30)[there]
                g *= np.take(self.experts, np.take(targets, at), axis=0)
                logs[place] = np.log(_sums(g)[:, :, 0] / total + 1e-30)[there]
        return logs, opens

    def words_logs(self, ids: np.ndarray, sizes: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        """log P of every word and of the end of every text, in turn, from the ids of the texts."""
        ends = np.cumsum(sizes)
        ids = np.insert(ids, ends, END)
        sizes = sizes + 1
        logs, opens = self.ids_logs(ids, sizes)
        first = np.flatnonzero(self.opens[ids])
        if len(first) != int((n_words + 1).sum()):
            raise AssertionError("words and ids do not agree")
        word = np.add.reduceat(logs, first) - opens[first]
        # After its last piece a word has to end: what follows opens a word. END ends by itself.
        follow = np.append(first[1:], 0)
        inner = ids[first] != END
        word[inner] += opens[follow[inner]]
        return word


_scorers: dict[int, Scorer] = {}


def _scorer(shared, model: str) -> Scorer:
    """The scorer of a broadcast model, made once in a worker."""
    made = shared.value
    if id(made) not in _scorers:
        _scorers.clear()
        _scorers[id(made)] = Scorer(*made, model)
    return _scorers[id(made)]


def _score(shared, model: str, n_train: int, totals: tuple[int, int]):
    def score(rows: pa.Table, told: pa.Table) -> pa.Table:
        scorer = _scorer(shared, model)
        n, v = totals
        order = np.argsort(told["owner"].to_numpy(), kind="stable")
        parts = told["counts"].to_pylist()
        counts = np.concatenate([large(parts[i]) for i in order] + [np.zeros(0, np.int64)])
        out: dict[str, list] = {c: [] for c in ("id", "held_out", "n_tokens", "n_known", "base_score", "score")}
        for ids, *cells in zip(*(rows[c].to_pylist() for c in CODED), strict=True):
            coded = Coded(*cells)
            n_words = coded.n_words.astype(np.int64)
            c = np.insert(counts[coded.back], np.cumsum(n_words), n_train)  # the end of each text is a token
            base = np.log((c + 1) / (n + v + 1))
            logs = scorer.words_logs(*coded.flow(np.ones(len(ids), bool)), n_words)
            mixed = np.logaddexp(np.log(SHARE) + logs, np.log(1 - SHARE) + base)
            first = np.cumsum(n_words + 1) - n_words - 1
            sums = lambda x: np.add.reduceat(x, first).tolist() if len(first) else []  # noqa: E731, B023
            out["id"].extend(ids), out["held_out"].extend(_held_out(ids).tolist())
            out["n_tokens"].extend((n_words + 1).tolist()), out["n_known"].extend(sums((c > 0).astype(np.int64)))
            out["base_score"].extend(sums(base / np.log(10))), out["score"].extend(sums(mixed / np.log(10)))
        kinds = [rows.schema.field("ids").type.value_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table({c: pa.array(x, k) for (c, x), k in zip(out.items(), kinds, strict=True)})

    return score


def lm_score(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    `model` is the path of the SentencePiece model that gives the ids. Documents
    whose crc32 of the id, modulo 7, is 2 are held out: nothing is learnt from
    them. Null texts are empty: one token, the end. A null id is not held out.
    Words are compared by 64-bit hashes. Without training documents every word is
    unknown. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    source = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    cells = ", ".join(f"{c} binary" for c in (*CODED[1:], "counts", "hashes"))
    blocks = written(source.mapInArrow(_code(model), f"block long, ids array<{kind}>, {cells}"), "coded")
    n_owners = max(1, blocks.count() // 8)
    told = blocks.select("block", "hashes", "counts").mapInArrow(_tell(n_owners), "block long, owner long, hashes binary, counts binary")
    counts = written(
        told.groupBy("owner").applyInArrow(_sum, "block long, owner long, counts binary, tokens long, distinct long"), "counts"
    )
    ids = blocks.select(F.explode("ids").alias("i"))
    key = F.crc32(F.col("i").cast("string").cast("binary")) % FOLDS
    n_train = ids.where(F.coalesce(key != HELD_OUT, F.lit(True))).count()
    sums = counts.agg(F.sum("tokens"), F.sum("distinct")).first()
    totals = (sums[0] or 0) + n_train, (sums[1] or 0) + (n_train > 0)
    windows = written(blocks.select(*CODED).mapInArrow(_windows, "n long, windows binary, seen binary, times binary"), "windows")
    shared = spark.sparkContext.broadcast(trained(windows, load(model).n))
    rows = blocks.select("block", *CODED).groupBy("block").cogroup(counts.select("block", "owner", "counts").groupBy("block")).applyInArrow(
        _score(shared, model, n_train, totals),
        f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return rows.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(totals[0]).cast("long").alias("train_tokens"),
        "base_score", "score",
    )
