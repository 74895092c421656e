"""Small tables and plain versions of the operators."""

import random
import re
import zlib
from collections import Counter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \n\t", "a", "x" * 3000, "Ünïcode ▁   text", "same text here", "same  text\there", "same text here"]


def docs_table(spark, texts, start=0):
    rows = [(start + i, t, ["en", "de", None][i % 3], ["s0", "s0", "s1", None][i % 4], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def prose(rng, n, vocabulary=400):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(vocabulary)}" for _ in range(n))


def some_texts(seed=0, n=60):
    """Texts of their own, copies, near copies, shared passages."""
    rng = random.Random(seed)
    passage = prose(rng, 70)
    out = list(ODD)
    for i in range(n):
        text = prose(rng, rng.randint(1, 120))
        kind = i % 6
        if kind == 1:
            text = out[-1] or text
        elif kind == 2:
            words = (out[-1] or text).split()
            words[len(words) // 2 : len(words) // 2 + 1] = ["other"]
            text = " ".join(words)
        elif kind == 3:
            text = f"{text} {passage} {prose(rng, 5)}"
        out.append(text)
    return out


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def components(texts, width, percent):
    """{number: (shingles, smallest number that links lead to)} by comparing all pairs."""
    sets = {}
    for i, t in enumerate(texts):
        w = words(lower(t))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]) and label[b] < label[a]:
                    label[a], changed = label[b], True
    return {i: (len(sets[i]), label[i]) for i in sets}


def is_held_out(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds == 2


def word_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        if not is_held_out(doc_id, 7):
            counts.update([*words(lower(text)), None])
    return counts
