"""Quality classifier: naive Bayes support vectors on n-gram indicators.

A text is the set of its n-grams: of words (one and two), and of word shapes
(one to three), where a shape says which kinds of characters a word has, how it
ends and whether it repeats the word before. N-grams are hashed. Indicators are
scaled by the log ratio of their smoothed shares in the two classes; a linear
hinge-loss model on these is fitted by dual coordinate descent and mixed with
the mean weight. Scores become probabilities by a logistic fit on margins of
halves that the model has not seen.

The fit is on at most `sample` labelled rows, the first by a hash of their ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm import flat
from feedmill.llm.common import bytes_of, pieces, slices, whole

#: Bits of a hashed n-gram.
BITS = 18
#: Most labelled rows of a fit: about 10 kB each in the task that fits.
SAMPLE = 8_000
EPOCHS = 12
#: Penalty of a margin error, smoothing of the counts, and the share of a weight kept against the mean one.
COST, SMOOTH, BETA = 1.0, 1.0, 0.5
#: Bytes of text taken together.
TOGETHER = 2 << 20
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2


def _kinds() -> np.ndarray:
    """One bit per kind of byte: lower, upper, digit, sentence mark, other sign, beyond ASCII."""
    kinds = np.full(256, 32, np.uint8)
    kinds[:128] = 16
    for first, last, bit in ((97, 122, 1), (65, 90, 2), (48, 57, 4)):
        kinds[first : last + 1] = bit
    for c in b".,;:'\"-()":
        kinds[c] = 8
    return kinds


KINDS = _kinds()
FACTORS = np.random.default_rng(11).integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)


def features(texts: list[bytes]) -> list[np.ndarray]:
    """The hashed n-grams of each text, each once."""
    buf, edges = flat.joined(texts)
    starts, ends = flat.words(buf)
    stamp = np.zeros(1 << BITS, np.int64)
    if not len(starts):
        return [np.zeros(0, np.int64) for _ in texts]
    words = flat.spans_hashed(flat.LOWER[buf], starts, ends)
    kind = np.bitwise_or.reduceat(KINDS[buf] * ~flat.SPACE[buf], starts).astype(np.uint64)
    shape = kind | (KINDS[buf[ends - 1]].astype(np.uint64) << np.uint64(8))
    shape |= (KINDS[buf[starts]].astype(np.uint64) << np.uint64(16))
    same = np.zeros(len(words), np.uint64)
    same[1:] = words[1:] == words[:-1]
    shape = flat.mixed((shape | (same << np.uint64(24))) + np.uint64(1))
    shift = np.uint64(64 - BITS)
    hashed = lambda x: (flat.mixed(x) >> shift).astype(np.int64)
    one, tail = hashed(words * FACTORS[0]), np.zeros(1, np.uint64)
    two = hashed(words * FACTORS[1] + np.append(words[1:], tail) * FACTORS[2])
    shapes = [hashed(shape * FACTORS[3])]
    shapes.append(hashed(shape * FACTORS[4] + np.append(shape[1:], tail) * FACTORS[5]))
    shapes.append(hashed(shape * FACTORS[5] + np.append(shape[1:], tail) * FACTORS[6] + np.append(shape[2:], [0, 0])[: len(shape)].astype(np.uint64) * FACTORS[7]))
    first = np.searchsorted(starts, edges)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        found = np.concatenate([one[a:b], two[a : b - 1], shapes[0][a:b], shapes[1][a : max(a, b - 1)], shapes[2][a : max(a, b - 2)]]) if b > a else one[:0]
        at = np.arange(len(found))
        stamp[found] = at  # the last place of each n-gram
        out.append(found[stamp[found] == at])
    return out


def log_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.full((2, 1 << BITS), SMOOTH)
    for x, y in zip(rows, labels.tolist(), strict=True):
        counts[y, x] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights on scaled indicators, and the bias: squared hinge loss, one dual variable at a time."""
    sign = np.where(labels == 1, 1.0, -1.0)
    # Rare classes weigh as much as frequent ones.
    cost = COST * len(labels) / (2 * np.bincount(labels, minlength=2)[labels].clip(1))
    weights, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(rows))
    scaled = [ratios[x] / max(1e-9, float(np.linalg.norm(ratios[x]))) for x in rows]
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            x, v = rows[i], scaled[i]
            slack = 0.5 / cost[i]
            gradient = sign[i] * (weights[x] @ v + bias) - 1 + slack * alpha[i]
            new = max(0.0, alpha[i] - gradient / (v @ v + 1 + slack))
            step = (new - alpha[i]) * sign[i]
            if step:
                weights[x] += step * v
                bias += step
                alpha[i] = new
    mean = np.abs(weights).sum() / max(1, np.count_nonzero(weights))
    return BETA * weights + (1 - BETA) * mean * np.sign(weights), bias


def margins(rows: list[np.ndarray], ratios: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    both, squares = weights * ratios, ratios * ratios
    return np.array([both[x].sum() / max(1e-9, float(np.sqrt(squares[x].sum()))) + bias for x in rows])


def logistic(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a probability on margins, by Newton steps on smoothed targets."""
    ones, zeros = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        theta = theta - np.linalg.solve(hessian, x.T @ (p - target) + 1e-4 * theta)
    return float(theta[0]), float(theta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> dict:
    """The model: weight of each n-gram, its square for the norm, bias, slope and offset."""
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        zero = np.zeros(1 << BITS)
        return {"weights": zero, "ratios": zero, "bias": 0.0, "slope": 0.0, "offset": float(np.log(share / (1 - share)))}
    half = np.arange(len(rows)) % 2
    unseen = np.zeros(len(rows))
    for k in (0, 1):
        own, other = np.flatnonzero(half != k), np.flatnonzero(half == k)
        part = [rows[i] for i in own]
        ratios = log_ratios(part, labels[own])
        unseen[other] = margins([rows[i] for i in other], ratios, *dual_descent(part, labels[own], ratios))
    ratios = log_ratios(rows, labels)
    weights, bias = dual_descent(rows, labels, ratios)
    slope, offset = logistic(unseen, labels)
    return {"weights": weights, "ratios": ratios, "bias": bias, "slope": slope, "offset": offset}


def _featured(batches):
    for batch in slices(batches):
        texts = bytes_of(batch["text"])
        for a, b in pieces([len(t) for t in texts], TOGETHER):
            packed = [x.astype(np.int32).tobytes() for x in features(texts[a:b])]
            yield pa.RecordBatch.from_arrays(
                [batch["label"].slice(a, b - a), batch["key"].slice(a, b - a), pa.array(packed, pa.binary())], ["label", "key", "grams"]
            )


def _fit(table: pa.Table) -> pa.Table:
    table = table.sort_by("key")
    rows = [np.frombuffer(x, np.int32).astype(np.int64) for x in table["grams"].to_pylist()]
    model = fit(rows, table["label"].to_numpy().astype(np.int64))
    out = {k: [v.astype(np.float32).tobytes()] if isinstance(v, np.ndarray) else [v] for k, v in model.items()}
    return pa.table(out, pa.schema([("weights", pa.binary()), ("ratios", pa.binary()), ("bias", pa.float64()), ("slope", pa.float64()), ("offset", pa.float64())]))


def held_out(id_col: str, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    """Whether a document is in the part that nothing is learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> dict:
    """The model of at most `sample` labelled documents that are not held out."""
    key = F.xxhash64(F.col(id_col))
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
        .select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("label"), key.alias("key"))
        .orderBy("key", "l_id", "label")
        .limit(sample)
    )
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("l_id"))
    grams = rows.select("label", "key", "text").mapInArrow(_featured, "label int, key long, grams binary")
    # One task holds the sample, which `sample` bounds.
    fitted = grams.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_fit, "weights binary, ratios binary, bias double, slope double, offset double").collect()
    if not fitted:
        return fit([], np.zeros(0, np.int64))
    model = fitted[0].asDict()
    return model | {k: np.frombuffer(model[k], np.float32).astype(float) for k in ("weights", "ratios")}


def _scorer(model: dict):
    def score(batches):
        both, squares = model["weights"] * model["ratios"], np.square(model["ratios"])
        for batch in slices(batches):
            texts = bytes_of(batch["text"])
            scores: list[float] = []
            for a, b in pieces([len(t) for t in texts], TOGETHER):
                for x in features(texts[a:b]):
                    margin = both[x].sum() / max(1e-9, float(np.sqrt(squares[x].sum()))) + model["bias"]
                    scores.append(float(1 / (1 + np.exp(-np.clip(model["slope"] * margin + model["offset"], -30, 30)))))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["held_out"], pa.array(scores, pa.float64())], ["id", "held_out", "score"])

    return score


def classify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    Null texts are empty; a text without words gets the score of the bias alone.
    With labels of one class only, or none, every score is that class's smoothed
    share. Other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), whole(text_col).alias("text"))
    slim = {k: v.astype(np.float32) if isinstance(v, np.ndarray) else v for k, v in model.items()}
    out = rows.mapInArrow(_scorer(slim), f"id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int")).withColumnRenamed("id", id_col)
