"""Quality rules: robust outliers by minimum-covariance-determinant estimates.

Each document gives a vector of transformed statistics. For every language and
source, location and scatter are those of the half of the documents with the
smallest covariance determinant, found by concentration steps that start from
medians. A document far from its group in Mahalanobis distance is rejected.

A concentration step is one grouped sum: distances fall into fine logarithmic
bins, moments are added up by group and bin, and the bins in order, the last in
part, make up the half. No group is ever gathered, whatever its size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import bytes_of, slices, whole, written

#: Characters that count as symbols; fixed values.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
FEATURES = ["f_length", "f_symbols", "f_lines", "f_repeats", "f_upper"]
#: Standard deviations below which a statistic is taken as noise, by feature.
FLOOR = [0.06, 0.10, 0.10, 0.10, 0.10]
MIN_WORDS = 50
MAX_REPEATS_PCT = 50
#: Share of a group that the estimate rests on; at 0.5, (n + p + 1) // 2 documents of n with p features.
SUPPORT = 0.5
STEPS = 4
#: Squared distances beyond this are rejected: the 1 - 1e-7 quantile of chi-square with 5 degrees is 40.9.
CUTOFF = 41.0
#: Groups with fewer documents are estimated by language alone.
MIN_GROUP = 50
BINS_PER_OCTAVE = 16
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long"


def statistics(text: bytes) -> tuple[int, int, int, int, int, int, int]:
    """The counts of one text; words are runs of anything but ASCII white space."""
    words = text.split()
    if not words:
        return (0, 0, sum(text.count(s) for s in SYMBOLS), 0, 0, 0, 0)
    joined = b"".join(words)
    chars = len(joined.decode("utf-8"))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    upper = len(joined) - len(joined.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    repeats = 0
    if len(ids) > 3:
        a = np.array(ids, np.int64)
        n = len(numbers)
        if n < 2_000_000:
            grams = (a[:-2] * n + a[1:-1]) * n + a[2:]
        else:
            pairs = np.unique(a[:-1] * n + a[1:], return_inverse=True)[1]
            grams = pairs[:-1] * n + a[2:]
        order = np.argsort(grams, kind="stable")
        s = grams[order]
        twin = np.zeros(len(s), bool)
        same = s[1:] == s[:-1]
        twin[1:] = same
        twin[:-1] |= same
        covered = np.zeros(len(a), bool)
        at = order[twin]
        for k in range(3):
            covered[at + k] = True
        repeats = int(covered.sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeats, len(lines), upper


def _measure(batches):
    for batch in slices(batches):
        found = [statistics(t) for t in bytes_of(batch["text"])]
        columns = list(zip(*found, strict=True)) if found else [[]] * 7
        arrays = [batch["id"], batch["lang"], batch["source"], batch["text_key"], *[pa.array(c, pa.int64()) for c in columns]]
        names = ["id", "lang", "source", "text_key", *[x.split()[0] for x in STATS.split(", ")]]
        yield pa.RecordBatch.from_arrays(arrays, names)


def measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """The counts of each document and, from them, the vector of transformed statistics."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"), whole(text_col).alias("text"), F.xxhash64(whole(text_col)).alias("text_key"),
    ).mapInArrow(_measure, f"id {kind}, lang string, source string, text_key long, {STATS}")
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return rows.withColumns(
        {
            "f_length": F.log((F.col("word_chars") + 1) / (words + 0.2)),
            "f_symbols": F.sqrt(F.col("n_symbols") / words),
            "f_lines": F.col("n_dup_lines") / (lines + 5),
            "f_repeats": F.col("n_repeat_words") / (words + 20),
            "f_upper": F.sqrt(F.col("n_upper") / (F.col("word_chars") + 50)),
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEATS_PCT * F.col("n_words")),
        }
    )


def _moments(p: int) -> list:
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES[:p])]
    cross = [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"c{i}{j}") for i in range(p) for j in range(i + 1)]
    return [F.count(F.lit(1)).alias("n"), *sums, *cross]


def _chi_square(x: float, p: int) -> float:
    """P(chi-square with an odd number p of degrees <= x)."""
    total, term = 0.0, math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for k in range(1, p, 2):
        total, term = total + term, term * x / (k + 2)
    return math.erf(math.sqrt(x / 2)) - total


def consistency(share: float, p: int) -> float:
    """What the scatter of the nearest `share` of normal data is multiplied with to be that of all."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi_square(mid, p) < share else (low, mid)
    return share / _chi_square(low, p + 2) if share < 1 else 1.0


def _estimate(support: float, consistent: bool = False):
    p = len(FEATURES)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        """Mean and inverse scatter of the share `support` with the smallest distances of a group."""
        pdf = pdf.sort_values("bin")
        n = pdf["n"].to_numpy(float)
        half = (n.sum() + p + 1) // 2
        h = max(1.0, min(n.sum(), np.floor(2 * half - n.sum() + 2 * (n.sum() - half) * support)))
        take = np.clip(h - (np.cumsum(n) - n), 0, n) / n
        mean = np.array([(take * pdf[f"s{i}"].to_numpy()).sum() for i in range(p)]) / h
        cov = np.empty((p, p))
        for i in range(p):
            for j in range(i + 1):
                cov[i, j] = cov[j, i] = (take * pdf[f"c{i}{j}"].to_numpy()).sum() / h - mean[i] * mean[j]
        if consistent:
            cov *= consistency(h / n.sum(), p)
        inverse = np.linalg.inv(cov + np.diag(np.square(FLOOR)))
        row = {"g_lang": pdf["lang"].iloc[0], "g_source": pdf["source"].iloc[0], "size": int(n.sum())}
        return pd.DataFrame([row | {"mean": mean.tolist(), "inverse": inverse.ravel().tolist()}])

    return fit


PARAMS = "g_lang string, g_source string, size long, mean array<double>, inverse array<double>"


def _distance() -> Column:
    p = len(FEATURES)
    gap = [F.col(f) - F.col("mean")[i] for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in range(p):
        for j in range(i + 1):
            total = total + gap[i] * gap[j] * F.col("inverse")[i * p + j] * (1 if i == j else 2)
    return F.greatest(total, F.lit(0.0))


def _with(rows: DataFrame, params: DataFrame) -> DataFrame:
    return rows.join(
        params, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")), "left"
    )


def _start(rows: DataFrame) -> DataFrame:
    """Medians of each feature and of the distances from them, from counts of fine steps by group."""
    step = 64.0
    steps = F.explode(
        F.array(*[F.struct(F.lit(i).alias("f"), F.round(F.col(f) * step).cast("int").alias("v")) for i, f in enumerate(FEATURES)])
    )
    counts = rows.select("lang", "source", steps.alias("x")).groupBy("lang", "source", "x.f", "x.v").agg(F.count(F.lit(1)).alias("n"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        mean, inverse = [0.0] * len(FEATURES), np.zeros((len(FEATURES), len(FEATURES)))

        def median(v: np.ndarray, n: np.ndarray) -> float:
            order = np.argsort(v, kind="stable")
            return float(v[order][np.searchsorted(np.cumsum(n[order]), n.sum() / 2)]) / step

        for f, part in pdf.groupby("f"):
            v, n = part["v"].to_numpy(), part["n"].to_numpy()
            mean[f] = median(v, n)
            # Unlike quartiles, this isn't moved by a third of outliers.
            spread = 1.4826 * median(np.abs(v - mean[f] * step), n)
            inverse[f, f] = 1 / (spread**2 + FLOOR[f] ** 2)
        row = {"g_lang": pdf["lang"].iloc[0], "g_source": pdf["source"].iloc[0], "size": int(pdf["n"].sum() // len(FEATURES))}
        return pd.DataFrame([row | {"mean": mean, "inverse": inverse.ravel().tolist()}])

    return counts.groupBy("lang", "source").applyInPandas(fit, PARAMS)


def minimum_covariance(rows: DataFrame, steps: int = STEPS, support: float = SUPPORT) -> DataFrame:
    """Per (lang, source): size, mean and inverse scatter of the concentrated part; a small table."""
    params = written(_start(rows), "mcd")
    for _ in range(steps):
        bins = F.floor(F.log2(_distance() + 1e-6) * BINS_PER_OCTAVE).cast("int")
        sums = _with(rows, params).withColumn("bin", bins).groupBy("lang", "source", "bin").agg(*_moments(len(FEATURES)))
        params = written(sums.groupBy("lang", "source").applyInPandas(_estimate(support, True), PARAMS), "mcd")
    return params


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    cutoff: float = CUTOFF,
) -> DataFrame:
    """One row per document: id, counts, base_failed, distance2 and kept.

    Estimates rest on the documents that pass the base rules. A null language or
    source is a group of its own; groups under `MIN_GROUP` documents are pooled by
    language. Without any estimate (a language of which nothing passed) the base
    rules decide alone. Null texts have no words and fail. Empty tables give no rows.
    """
    rows = written(measured(docs, id_col, text_col, lang_col, source_col), "statistics")
    good = rows.where(~F.col("base_failed"))
    sizes = good.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= MIN_GROUP)
    large = written(sizes.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), F.lit(True).alias("own")), "groups")
    pooled = _with(rows, large).withColumns(
        {"real_source": F.col("source"), "source": F.when(F.col("own"), F.concat(F.lit("="), F.coalesce("source", F.lit("")))).otherwise(F.lit("pooled")), "null_source": F.col("source").isNull()}
    ).drop("g_lang", "g_source", "own")
    # A null source and an empty one are groups apart.
    pooled = pooled.withColumn("source", F.when(F.col("null_source") & (F.col("source") == "="), F.lit("null")).otherwise(F.col("source")))
    params = minimum_covariance(pooled.where(~F.col("base_failed")))
    judged = _with(pooled, params).withColumn("distance2", _distance())
    keep = ~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= cutoff)
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", keep.alias("kept"), "distance2", "text_key",
    )


def drop_outliers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: str) -> DataFrame:
    """The rows of `docs` that the rules keep. Rows with the same id are judged each by its own text and source."""
    verdict = quality_rules(docs, id_col, text_col, **more)
    gone = verdict.where(~F.col("kept")).select(F.col(id_col).alias("__id"), F.col("text_key").alias("__key")).distinct()
    match = F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(whole(text_col)) == F.col("__key"))
    return docs.join(gone, match, "left_anti").select(*docs.columns)
