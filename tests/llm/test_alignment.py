"""Token alignment against the public libraries and a plain version."""

import hashlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedmill.llm import token_alignment
from feedmill.llm.token_alignment import align, align_tokens, byte_letters, check_same_ids
from tests.llm.helpers import ODD, docs_table, some_texts

RANKS, JSON = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("tiktoken", "json"))
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    *ODD, " a", "a▁b", "<|endoftext|> x<s></s>", "  b  　c  d", "a\r\n\t  b's don't 12 ½", "🙂 x\u0000y", "\n", "é ",
    "日本語 テキスト", "a  b   c   d", "!  ?'s 're",
]


def plain(texts):
    first, second = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    first.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(byte_letters())}

    def bytes_a(i):
        return bytes(letters[c] for c in first.id_to_token(i))

    def bytes_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    rows, links = [], []
    for text in texts:
        raw = f" {text}".encode() if text else b""
        a = first.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        if b"".join(map(bytes_a, a)) != raw or b"".join(map(bytes_b, b)) != raw:
            a, b = [], []
        spans = []
        for ids, size in ((a, bytes_a), (b, bytes_b)):
            at, own = 0, []
            for i in ids:
                own.append((i, at, at + len(size(i))))
                at += len(size(i))
            spans.append(own)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, _, e in own if low < e <= cut) for own in spans))
            low = cut
        both = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        links.append(both)
        rows.append([len(a), len(b), len(cuts), len(both), 0, 0, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
    counts = Counter(pair for both in links for pair in both)
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    for row, both in zip(rows, links, strict=True):
        row[4] = sum(counts[p] == best[p[1]] for p in both)
        row[5] = sum(counts[p] for p in both)
    return rows


def test_same_ids():
    check_same_ids(JSON, RANKS)


@pytest.mark.parametrize("chunk", [1 << 23, 1 << 10])
def test_same_as_plain(spark, monkeypatch, chunk):
    monkeypatch.setattr(token_alignment, "CHUNK", chunk)
    texts = [*TEXTS, *some_texts(3, 40), "the end " * 40_000]
    short = texts[:-1]
    found = {r["doc_id"]: list(r[1:]) for r in align_tokens(docs_table(spark, short), RANKS, public_tokenizers.PATTERN, MODEL).collect()}
    assert [found[i] for i in range(len(short))] == plain(short)


def test_long_text(spark):
    docs = docs_table(spark, ["the end " * 40_000, "y" * 300_000])
    rows = align_tokens(docs, RANKS, public_tokenizers.PATTERN, MODEL).orderBy("doc_id").collect()
    assert [r["n_links"] for r in rows] == [r["n_a"] + r["n_b"] - r["n_groups"] for r in rows]
    assert all(r["n_a"] > 1000 and r["groups_sha256"] for r in rows)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert align_tokens(empty, RANKS, public_tokenizers.PATTERN, MODEL).count() == 0
    names = ["chunk", "ids", "pair", "links", "n_a", "total", "best", "text_"]
    rows = spark.createDataFrame([("b", "same text"), ("b", "same text"), (None, None)], "doc_id string, text string")
    found = align_tokens(rows.withColumns({c: F.lit(7) for c in names}), RANKS, public_tokenizers.PATTERN, MODEL)
    assert sorted((r["doc_id"] or "", r["n_a"], r["count_sum"]) for r in found.collect()) == [("", 0, 0), ("b", 2, 4), ("b", 2, 4)]


def test_align_one_text():
    a, b = (pa.array([x], pa.list_(pa.int32())) for x in ([1, 2, 3], [1, 0]))
    links, figures = align(a, b, pa.array([4, 1, 2, 3]), pa.array([4, 2]))
    assert links.to_pylist() == [{"text": 0, "a": i, "b": j} for i, j in ((1, 1), (2, 1), (2, 0), (3, 0))]
    assert figures["n_groups"].to_pylist() == [1]
    assert figures["groups_sha256"].to_pylist() == [hashlib.sha256(b"1,2,3|1,0").hexdigest()]
