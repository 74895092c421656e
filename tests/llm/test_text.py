import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from feedmill.llm import flat, html_text, lm_score, quality_classifier, sentence_pieces
from feedmill.llm.parts import Remembered
from tests.llm.helpers import ODD, docs_table, is_held_out, lower, prose, some_texts, word_counts, words


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(model):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def test_pieces_are_those_of_the_library(model, library):
    rng = random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "▁", "é", "😀", "Ａ", "\0", "ing", "1", "==", "aaaa", "     ", "　", "中文", "e", "r", "<0x0A>", "<s>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["ab" * 5000, " " * 300, "=-" * 999, "x" * 20000]
    tool = sentence_pieces.load(model)
    ids, sizes = tool.encode([t.encode() for t in texts])
    wanted = library.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == wanted
    assert [t.decode() for t in tool.decode(ids, sizes)] == [library.decode(x) for x in wanted]
    assert tool.decimals(ids, sizes) == [",".join(map(str, x)).encode() for x in wanted]


def test_known_parts_are_forgotten_without_harm(model, library, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "REMEMBERED", 20)
    tool = sentence_pieces.Pieces(model)
    for seed in range(5):
        texts = [prose(random.Random(seed), 60) for _ in range(3)]
        assert tool.encode([t.encode() for t in texts])[0].tolist() == sum(library.encode(texts), [])


def test_words_that_sums_of_powers_confuse(model, library):
    """A Thue-Morse word and its complement have equal polynomial hashes modulo powers of two."""
    word = "a"
    for _ in range(12):
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [w for n in (1024, 2048, 4096) for w in (word[:n], word[:n].translate(str.maketrans("ab", "ba")))]
    tool = sentence_pieces.Pieces(model)
    ids, sizes = tool.encode([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == library.encode(texts)
    buf, edges = flat.joined([t.encode() for t in texts])
    assert len(set(flat.spans_hashed(buf, edges[:-1], edges[1:] - 1).tolist())) == len(texts)


def test_two_hashes_that_disagree_stop_the_memory():
    """Where a hash says that two parts are one and the other doesn't, each part is encoded by itself."""
    memory, asked = Remembered(10), []

    def encode(starts, ends):
        asked.append(len(starts))
        return starts, np.ones(len(starts), np.int64)

    buf, starts, ends = np.arange(6, dtype=np.uint8), np.array([0, 2, 4]), np.array([2, 4, 6])
    assert memory.ids(buf, starts, ends, encode)[0].tolist() == [0, 2, 4]
    memory._check = memory._check[::-1].copy()
    assert memory.ids(buf, starts[:2], ends[:2], encode)[0].tolist() == [0, 2] and asked == [3, 2]


def test_encoding_and_decoding_tables(spark, model, library):
    texts = some_texts()
    df = docs_table(spark, texts)
    encoded = sentence_pieces.encode_pieces(df, model)
    for r in encoded.collect():
        ids = library.encode(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ids, library.decode(ids))
    back = {r.doc_id: r.text for r in sentence_pieces.decode_pieces(encoded, model).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}
    assert sentence_pieces.encode_pieces(df.limit(0), model).count() == 0


def test_table_labels_fit_the_tree():
    rows, labels = html_text.labelled()
    assert [html_text.is_main(r) for r in rows] == [bool(x) for x in labels]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body><header><h2>Site</h2></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>A &amp; B</h1><p>First   line<br>goes on &lt;here&gt;.
<p>Sh is.</p><div class="ad">Buy</div><aside>Side</aside><form>Mail <input></form><!-- <p>gone</p> -->
<p>Last &eacute;nd.</article><section id="comments"><p>Me too, me too, I do like this a lot and say so at length.</p></section>
<footer>&copy; me</footer>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == "A & B\nFirst line goes on <here>.\nSh is.\nLast énd."
    assert html_text.main_text("<article><p>cut &am") == "cut &am"
    assert html_text.main_text("<article><p>cut</p><p cla") == "cut"
    assert html_text.main_text("<nav><a>x</a></nav>") == ""
    long = "word " * 80
    assert html_text.main_text(f"<div><a>Home</a></div><div>{long}</div><div>{long}</div><div><a>More</a></div>") == "\n".join([long.strip()] * 2)


ARTICLE = "<article><h1>Head line</h1>" + "".join(f"<p>Part {i} {'of a long text here ' * 12}</p>" for i in range(3)) + "</article>"


@pytest.mark.parametrize(
    "frame",
    [
        "<form id='aspnetForm'>{}</form>",
        "<div class='layout with-sidebar'>{}</div>",
        "<div class='content no-comments'>{}</div>",
        "<div id='page' class='share-enabled'>{}</div>",
        "<div class='l-side-by-side'>{}</div>",
        "<div class='modal-open'>{}</div>",
        "<div class='widget-area'><main>{}</main></div>",
        "<div class='sidebar'><main>{}</main></div>",
        "<section class='page menuOpen'>{}</section>",
    ],
)
def test_frames_that_an_article_leads_out_of(frame):
    text = html_text.main_text(ARTICLE)
    assert text.count("\n") == 3
    assert html_text.main_text(f"<body><nav><a>Home</a></nav>{frame.format(ARTICLE)}<footer>End</footer>") == text


@pytest.mark.parametrize(
    "frame",
    [
        "<section id='comments'>{}</section>",
        "<div class='comments-area'><main>{}</main></div>",
        "<div class='ad-box'>{}</div>",
        "<aside>{}</aside>",
        "<div class='sidebar'>{}</div>",
        "<div style='display: none'>{}</div>",
        "<div class='widget relatedPosts'>{}</div>",
        "<form class='comment-form'>{}</form>",
    ],
)
def test_frames_that_stay_frames(frame):
    assert html_text.main_text(f"<body>{frame.format(ARTICLE)}") == ""


def test_tree_between_the_rows_of_its_table():
    """In articles plain text stays whatever stands around it and runs of links go; in frames all goes."""
    sides = [(0, 0.0), (1, 0.0), (3, 1.0), (9, 0.0), (30, 0.1), (60, 1.0), (90, 0.0), (400, 0.0)]
    for words in (1, 2, 5, 14, 22, 23, 40, 120, 500):
        for before in sides:
            for after in sides:
                around = [*before, *after]
                assert html_text.is_main([words, 0.0, *around, 1])
                assert html_text.is_main([words, 0.15, *around, 1])
                assert not html_text.is_main([words, 0.0, *around, 2])
                if words < 30 and before[1] == 1.0 or after[1] == 1.0 and words < 12:
                    assert not html_text.is_main([words, 1.0, *around, 0])
                if words < 12 and before[1] == after[1] == 1.0:
                    assert not html_text.is_main([words, 1.0, *around, 1])
    for words in (20, 40, 300):
        assert html_text.is_main([words, 0.0, 50, 0.0, 50, 0.0, 0])


def test_list_of_links_in_an_article():
    links = "<ul>" + "".join(f"<li><a href='/{i}'>More of {i}</a></li>" for i in range(8)) + "</ul>"
    assert html_text.main_text(ARTICLE.replace("</article>", links + "</article>")) == html_text.main_text(ARTICLE)
    one = "<p><a href='/x'>A link alone</a></p>"
    inside = html_text.main_text(ARTICLE.replace("<p>Part 1", one + "<p>Part 1"))
    assert inside.split("\n")[2] == "A link alone"


def test_dropped_elements_end_with_their_parent():
    for page, text in (
        ('<p>One <svg class="i"/>two</p><p>Three <svg><text>no</text></svg>four</p>', "One two\nThree four"),
        ("<p>One <button>no</p><p>Two</p><div><button>no</button></div><p>Three</p>", "One\nTwo\nThree"),
        ("<p>One</p><video src=a><p>Two</p>", "One\nTwo"),
        ("<div><p>One</p><object>no</div><p>Two</p><p>x <object><p>no</p></object>y</p>", "One\nTwo\nx y"),
        ("<video-player><p>One</p></video-player><button-group>Two</button-group>", "One\nTwo"),
        ("<p>One</p><select><option>no<option>no</select><script>no<p>no", "One"),
        ("<p>A <button title='x>y'>no</button> b <canvas>no</canvas>c</p>", "A b c"),
    ):
        assert html_text.main_text(f"<article>{page}") == text
    for page in ("<object>" * 3000 + "</object>", "<button>" * 20000 + "</button>", "<svg>" * 3000 + "</p>" * 3000 + "</svg>"):
        html_text.main_text(page)


def test_broken_markup_takes_no_quadratic_time():
    for page in ("<a" * 100000, '<a "' * 20000, "<" * 100000, "<script>" * 20000, "<p>" * 50000):
        html_text.main_text(page)


def test_pages_table(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (2, "v", "", "x"), (None, "w", "<article>hi", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.extract(df).collect()
    assert sorted((str(r.page_id), r.url or "", r.n_chars) for r in found) == [("1", "u", 49), ("2", "", 0), ("2", "v", 0), ("None", "w", 2)]
    assert html_text.extract(df.limit(0)).count() == 0


def test_gradients_are_those_of_differences():
    rng = np.random.default_rng(0)
    n = 12
    vector = lm_score.initial(rng.integers(1, 9, n)).astype(np.float64)
    rows = rng.integers(0, n, (3, lm_score.WINDOW + 1)).astype(np.int32)
    rows[2, 9:] = -1

    def loss(v):
        p = lm_score.unpack(v, n)
        experts = lm_score._softmax(p["experts"].T).T
        x, y = np.maximum(rows[:, :-1], 0), np.maximum(rows[:, 1:], 0)
        g = lm_score.forward(p, x)[6]
        there = rows[:, 1:] >= 0
        return -(np.log((g * experts[y]).sum(axis=2)) * there).sum() / there.sum()

    p = lm_score.unpack(vector, n)
    grads = lm_score.gradients(p, lm_score._softmax(p["experts"].T).T, rows)
    found = np.concatenate([grads[k].ravel() for k in lm_score.shapes(n)])
    for i in rng.integers(0, len(vector), 60):
        step = np.zeros_like(vector)
        step[i] = 1e-5
        assert found[i] == pytest.approx((loss(vector + step) - loss(vector - step)) / 2e-5, abs=1e-4)


def test_a_text_is_encoded_once(spark, model, monkeypatch):
    """What is learnt and what is scored are the ids of one encoding, made of those of the distinct words."""
    texts = [*ODD, "a \u2581b c\u2581 \u2581", prose(random.Random(3), 500, 50), *some_texts(4, 20)]
    tool, sizes = sentence_pieces.Pieces(model), [len(t.encode()) for t in texts if t]
    blob = zstandard.compress("".join(t or "" for t in texts).encode())
    w = lm_score.Words(np.array([len((t or "").encode()) for t in texts], np.int64).tobytes(), blob)
    assert len(w.values) < len(w.back) and sum(sizes) == len(w.buf) - len(texts)
    pieces, k = tool.encode_spans(*w.spoken())
    coded = lm_score.Coded(*(lm_score.small(x) for x in (np.diff(w.first), w.back, k, pieces)))
    assert (lm_score.risen(lm_score.steps(w.values)) == w.values).all() and not len(lm_score.risen(lm_score.steps(w.values[:0])))
    spoken = [" ".join(words(lower(t))).replace(sentence_pieces.SPACE, "_").encode() for t in texts]
    for docs in (np.ones(len(texts), bool), np.arange(len(texts)) % 3 > 0, np.zeros(len(texts), bool)):
        ids, n = tool.encode([t for t, there in zip(spoken, docs, strict=True) if there])
        found, many = coded.flow(docs)
        assert found.tolist() == ids.tolist() and many.tolist() == n.tolist()


def test_steps_in_parts_have_the_same_gradients(monkeypatch):
    rng = np.random.default_rng(2)
    vector = lm_score.initial(rng.integers(1, 9, 15)).astype(np.float64)
    rows = rng.integers(0, 15, (7, lm_score.WINDOW + 1)).astype(np.int32)
    rows[3, 5:] = rows[6, 2:] = -1
    p = lm_score.unpack(vector, 15)
    whole = lm_score.gradients(p, lm_score._softmax(p["experts"].T).T, rows)
    monkeypatch.setattr(lm_score, "BATCH", 3)
    parts = lm_score.gradients(p, lm_score._softmax(p["experts"].T).T, rows)
    assert all(np.allclose(whole[n], parts[n], atol=1e-12) for n in lm_score.shapes(15))


def test_attention_looks_back_only():
    p = lm_score.unpack(lm_score.initial(np.ones(9)), 9)
    x = np.random.default_rng(1).integers(0, 9, (1, lm_score.WINDOW))
    y = x.copy()
    y[0, 20:] = 0
    assert np.allclose(lm_score.forward(p, x)[6][0, :20], lm_score.forward(p, y)[6][0, :20])


def test_later_windows_are_asked_for_their_new_places_only(model, monkeypatch):
    """Every id has the probability that its whole window gives it; no more is worked out than the places of new ids."""
    tool, rng = sentence_pieces.load(model), np.random.default_rng(5)
    compact = np.zeros(tool.n, np.int64)
    compact[np.r_[lm_score.BEGIN, lm_score.END, 400:430]] = np.arange(1, 33)
    scorer = lm_score.Scorer(lm_score.initial(rng.integers(1, 9, 33)), compact, model)
    sizes = np.array([1, lm_score.WINDOW, lm_score.WINDOW + 1, 3000, 7])
    ids = rng.integers(390, 430, sizes.sum())  # some without a number
    ids[np.cumsum(sizes) - 1] = lm_score.END
    forward, places = lm_score.forward, []

    def counted(*args, **kinds):
        made = forward(*args, **kinds)
        places.append(made[6].shape[0] * made[6].shape[1])
        return made

    with monkeypatch.context() as patch:
        patch.setattr(lm_score, "forward", counted)
        logs, opens = scorer.ids_logs(ids, sizes)
    back = lm_score.WINDOW - lm_score.STRIDE
    assert sum(places) <= sum(max(n + lm_score.STRIDE, lm_score.WINDOW) for n in sizes.tolist())
    for text, at in zip(np.split(ids, np.cumsum(sizes)[:-1]), (np.cumsum(sizes) - sizes).tolist(), strict=True):
        inputs = compact[np.append(lm_score.BEGIN, text)]
        for i in range(len(text)):
            base = max(0, (i - back) // lm_score.STRIDE * lm_score.STRIDE) if i >= lm_score.WINDOW else 0
            g = forward(scorer.p, inputs[None, np.minimum(np.arange(base, base + lm_score.WINDOW), len(text))])[6][0, i - base]
            assert g.sum() == pytest.approx(1, rel=1e-5)
            assert logs[at + i] == pytest.approx(np.log(g @ scorer.experts[compact[text[i]]]), rel=1e-4)
            assert opens[at + i] == pytest.approx(np.log(g @ scorer.experts[compact[scorer.opens]].sum(axis=0)), rel=1e-4, abs=1e-5)


def test_windows_tell_the_counts_of_their_targets(model):
    """Ids are counted where windows are made: the table of windows is not read once more for it."""
    texts = ["", "a b a", "  odd \u2581 words " * 40, prose(random.Random(6), 900)]
    w = lm_score.Words(np.array([len(t.encode()) for t in texts], np.int64).tobytes(), zstandard.compress("".join(texts).encode()))
    pieces, k = sentence_pieces.load(model).encode_spans(*w.spoken())
    cells = {c: pa.array([lm_score.small(x)]) for c, x in zip(lm_score.CODED[1:], (np.diff(w.first), w.back, k, pieces), strict=True)}
    for ids in ([0, 1, 2, 3], [i for i in range(99) if is_held_out(i, 7)][: len(texts)]):
        (row,) = lm_score._windows([pa.RecordBatch.from_pydict({"ids": pa.array([ids]), **cells})])
        targets = np.frombuffer(row["windows"][0].as_py(), np.int32).reshape(-1, lm_score.WINDOW + 1)[:, 1:]
        seen, times = (lm_score.large(row[c][0].as_py()) for c in ("seen", "times"))
        assert dict(zip(seen.tolist(), times.tolist(), strict=True)) == dict(Counter(targets[targets >= 0].tolist()))


def test_scores_of_a_table(spark, model):
    texts = [*some_texts(2, 60), *[prose(random.Random(i), 90, 40) for i in range(60)]]
    df = docs_table(spark, texts)
    rows = lm_score.lm_score(df, model).collect()
    counts = word_counts(enumerate(texts))
    total, kinds = sum(counts.values()), len(counts)
    for r in rows:
        tokens = [*words(lower(texts[r.doc_id])), None]
        base = sum(np.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        known = sum(counts[t] > 0 for t in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(tokens), known, total, is_held_out(r.doc_id, 7))
        assert r.score < 0 and r.score >= base + len(tokens) * np.log10(1 - lm_score.SHARE) - 1e-6
    assert len(rows) == len(texts)
    assert lm_score.lm_score(df.limit(0), model).count() == 0


def test_model_learns_from_whole_texts(spark, model, library, monkeypatch):
    """Every id of every training text, and its end, is a target once and has a number of its own."""
    texts = [*ODD, prose(random.Random(8), 3000), *some_texts(3, 30)]
    seen = {}

    def noted(windows, n_ids):
        rows = [np.frombuffer(r.windows, np.int32).reshape(-1, lm_score.WINDOW + 1) for r in windows.collect()]
        seen["rows"], seen["made"] = np.concatenate(rows), trained(windows, n_ids)
        return seen["made"]

    trained = lm_score.trained
    monkeypatch.setattr(lm_score, "trained", noted)
    monkeypatch.setattr(lm_score, "STEPS", 1)
    lm_score.lm_score(docs_table(spark, texts), model).count()
    spoken = [" ".join(words(lower(t))).replace(sentence_pieces.SPACE, "_") for i, t in enumerate(texts) if not is_held_out(i, 7)]
    wanted = [[*library.encode(t), lm_score.END] for t in spoken]
    rows, found, text = seen["rows"], [], []
    for row in rows:
        if row[0] == lm_score.BEGIN:
            text = []
            found.append(text)
        text.extend(row[1:][row[1:] >= 0].tolist())
    assert sorted(found) == sorted(wanted)
    compact = seen["made"][1]
    assert all(compact[i] > 0 for t in wanted for i in t)


def test_every_window_is_in_one_round(monkeypatch):
    monkeypatch.setattr(lm_score, "POOL", 5)
    rows = np.arange(23 * (lm_score.WINDOW + 1), dtype=np.int32).reshape(23, -1)
    batch = pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in np.split(rows, [4, 5, 5, 17])])], ["windows"])
    pools = [p for r in range(lm_score.ROUNDS) for p in lm_score._pools([batch], np.arange(rows.size), r)]
    assert sorted(map(tuple, np.concatenate(pools))) == sorted(map(tuple, rows))


def test_classifier_tells_unseen_junk(spark):
    rng = random.Random(4)
    texts, labels = list(ODD), []
    for i in range(400):
        junk = i % 5 == 0
        text = prose(rng, 60, 30)
        texts.append(" ".join(f"{w}{rng.choice(['%%%', '$$$'])}" for w in text.split()) if junk else text)
        labels.append((len(ODD) + i, int(not junk)))
    docs = docs_table(spark, texts)
    table = spark.createDataFrame([*labels, (None, 1), (3, None), (10, 5)], "doc_id long, quality int")
    model = quality_classifier.train(docs, table)
    rows = {r.doc_id: r for r in quality_classifier.classify(docs, model).collect()}
    assert len(rows) == len(texts)
    unseen = [(rows[i], y) for i, y in labels if is_held_out(i, 4)]
    assert all(r.held_out for r, _ in unseen) and len(unseen) > 60
    assert sum(r.predicted == y for r, y in unseen) >= 0.97 * len(unseen)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())


def test_classifier_without_labels(spark):
    docs = docs_table(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(3, 1), (4, 1), (6, 1)], "doc_id long, quality int")
    assert {r.score for r in quality_classifier.classify(docs, quality_classifier.train(docs, none)).collect()} == {0.5}
    assert all(r.score > 0.5 for r in quality_classifier.classify(docs, quality_classifier.train(docs, one)).collect())
