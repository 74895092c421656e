"""Main text of HTML pages: flat text blocks judged by a decision tree.

A page becomes a flat list of text blocks. Each block is described by its number
of words and its link density, by those of the blocks before and after, and by
the place it stands in. A decision tree, grown from the small labelled table
below, tells main text from the rest.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm.common import slices, whole

# Elements of HTML by what they mean for the text.
RAW = "script style title textarea iframe noscript".split()  # all up to the end tag, or to the end of the page
DROPPED = set("svg template select button object video audio canvas".split())  # up to the end tag, or to that of a parent
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = {"br", "wbr", "img", "input"}
FRAME = set("nav footer aside form dialog menu search fieldset".split())
FRAME_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie "
    "cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup "
    "share sharing social sidebar side rail menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar footer "
    "masthead comment comments commentlist reply replies respond disqus discussion related recommended "
    "recommendations widget pagination pager login search form skip hidden".split()
)
# Names that say whose text it is: what stands in such a frame is never the page's own article.
OTHERS_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion comment comments "
    "commentlist reply replies respond disqus discussion related recommended recommendations hidden".split()
)
# A name after one of these, or before one of those, says something of the page, not of the element.
DENIALS = set("with has have no non not without hide hides show shows".split())
STATES = set("open opened closed enabled disabled active inactive on off free visible ready loaded".split())
FRAME_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
ENDS_BEFORE = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^<>]*+>.*?(?:</(?P=raw)\b[^>]*+(?:>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/<>]*+)(?P<attrs>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-z][^<>]*+(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
DROPPED_END = re.compile(r"</(" + "|".join(sorted(DROPPED)) + r")(?=[\s/>])", re.I)
ATTR = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

PLAIN, IN_ARTICLE, IN_FRAME = 0, 1, 2
# Frames by what leads out of them: an article or main element, a main element alone, nothing.
LOOSE, FIRM, SEALED = 2, 3, 4
FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "place"]
#: The labelled table: the features (links in per cent of words) and whether the block is main text.
LABELLED = """
6 0 0 0 120 0 1 1
2 0 90 0 60 0 1 1
1 0 40 0 55 0 1 1
1 0 3 0 0 0 1 1
80 0 6 0 90 0 1 1
35 10 80 0 60 5 1 1
140 2 1 0 3 0 1 1
12 0 150 0 10 100 1 1
9 0 5 0 8 0 1 1
60 0 0 0 0 0 1 1
25 40 60 0 70 0 1 1
8 100 50 0 60 0 1 1
4 100 30 0 45 0 1 1
300 0 12 0 4 0 1 1
18 0 1 100 40 0 1 1
3 0 0 0 2 0 1 1
2 0 0 0 1 0 1 1
1 0 200 0 1 0 1 1
1 0 2 0 2 0 1 1
5 60 4 0 3 100 1 1
13 0 2 100 0 0 1 1
30 90 20 0 2 100 1 1
60 0 2 0 3 100 1 1
25 0 0 0 4 100 1 1
200 0 10 0 2 100 1 1
40 5 3 100 3 100 1 1
8 0 3 100 5 100 1 1
3 0 5 100 5 100 1 1
2 0 60 0 4 100 1 1
1 0 0 0 3 100 1 1
15 10 9 0 6 100 1 1
90 20 5 100 60 0 1 1
12 0 2 100 3 100 1 1
4 0 0 0 2 100 1 1
3 100 61 0 61 0 1 1
5 100 25 0 30 0 1 1
10 100 150 0 200 0 1 1
1 100 90 0 15 0 1 1
2 100 12 0 70 0 1 1
6 100 55 0 0 0 1 1
2 100 40 0 3 100 1 0
3 100 3 100 3 100 1 0
1 100 2 100 1 100 1 0
5 100 6 100 4 100 1 0
4 100 2 100 70 0 1 0
3 100 4 100 0 0 1 0
2 100 90 0 2 100 1 0
6 100 1 0 5 100 1 0
9 100 8 100 11 100 1 0
2 95 3 100 1 100 1 0
1 100 0 0 1 100 2 0
2 100 1 100 3 100 2 0
7 0 1 100 9 0 2 0
12 0 60 0 0 0 2 0
40 0 100 0 12 0 2 0
75 5 80 0 60 0 2 0
200 0 35 0 90 0 2 0
1 0 0 0 0 0 2 0
22 30 5 0 18 20 2 0
10 0 120 0 1 100 2 0
90 0 7 0 0 0 2 0
3 0 80 0 70 0 2 0
5 20 40 0 30 10 2 0
14 0 300 0 0 0 2 0
16 0 140 0 0 0 2 0
60 0 200 0 0 0 2 0
11 0 0 0 150 0 2 0
24 0 3 100 220 0 2 0
33 0 170 0 130 0 2 0
150 0 0 0 0 0 2 0
260 0 180 0 240 0 2 0
55 0 65 0 58 0 2 0
17 50 190 0 21 40 2 0
1 100 0 0 100 0 0 0
1 100 80 0 0 0 0 0
3 100 90 0 1 100 0 0
2 100 1 100 70 0 0 0
6 100 60 0 55 0 0 0
1 100 1 100 1 100 0 0
2 100 0 0 2 100 0 0
3 100 2 100 60 0 0 0
5 80 4 100 3 100 0 0
12 90 3 100 4 100 0 0
20 70 15 60 14 80 0 0
30 60 10 80 12 70 0 0
4 0 2 100 1 100 0 0
3 0 0 0 1 100 0 0
6 0 2 100 3 100 0 0
2 0 1 0 2 0 0 0
5 0 2 0 3 0 0 0
8 0 4 0 0 0 0 0
9 0 3 50 0 0 0 0
7 50 90 0 0 0 0 0
10 40 60 0 2 100 0 0
60 0 5 0 70 0 0 1
45 5 60 0 80 0 0 1
120 0 1 100 90 0 0 1
90 10 80 0 4 100 0 1
30 0 45 0 50 0 0 1
22 0 5 0 60 5 0 1
25 15 70 0 40 0 0 1
6 0 2 100 80 0 0 1
4 0 60 0 75 0 0 1
8 0 100 0 90 0 0 1
2 0 45 0 50 0 0 1
1 0 30 0 40 5 0 1
40 20 50 0 35 10 0 1
20 0 40 0 30 0 0 1
11 0 70 0 55 0 0 1
40 0 60 0 5 0 0 1
25 0 80 0 3 100 0 1
35 0 95 0 0 0 0 1
18 5 70 0 4 0 0 1
"""


def labelled() -> tuple[list[list[float]], list[int]]:
    rows = [[float(x) for x in line.split()] for line in LABELLED.split("\n") if line]
    return [[r[0], r[1] / 100, r[2], r[3] / 100, r[4], r[5] / 100, r[6]] for r in rows], [int(r[7]) for r in rows]


def grow(rows: list[list[float]], labels: list[int], depth: int = 8) -> dict:
    """A binary decision tree by Gini impurity; leaves hold the majority."""

    def impure(part: list[int]) -> float:
        ones = sum(labels[i] for i in part)
        return 2 * ones * (len(part) - ones) / len(part)

    def node(part: list[int], left: int) -> dict:
        ones = sum(labels[i] for i in part)
        if left == 0 or ones in (0, len(part)):
            return {"label": int(2 * ones >= len(part))}
        best = None
        for f in range(len(rows[0])):
            values = sorted({rows[i][f] for i in part})
            for low, high in zip(values, values[1:], strict=False):
                cut = (low + high) / 2
                parts = [i for i in part if rows[i][f] <= cut], [i for i in part if rows[i][f] > cut]
                cost = impure(parts[0]) + impure(parts[1])
                if best is None or cost < best[0] - 1e-12:
                    best = cost, f, cut, parts
        if best is None:
            return {"label": int(2 * ones >= len(part))}
        return {"feature": best[1], "cut": best[2], "low": node(best[3][0], left - 1), "high": node(best[3][1], left - 1)}

    return node(list(range(len(rows))), depth)


@lru_cache(maxsize=1)
def tree() -> dict:
    return grow(*labelled())


def is_main(features: list[float], at: dict | None = None) -> bool:
    at = at or tree()
    while "label" not in at:
        at = at["low"] if features[at["feature"]] <= at["cut"] else at["high"]
    return bool(at["label"])


def _named(value: str) -> int:
    """The frame that a class or id names, 0 if none: firm if a name is one of the fixed ones as a whole."""
    frame = 0
    for name in value.split():
        words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
        if not words or words[-1] in STATES:
            continue
        for before, word in zip(["", *words], words, strict=False):
            if word in FRAME_NAMES and before not in DENIALS:
                frame = max(frame, SEALED if word in OTHERS_NAMES else FIRM if len(words) == 1 else LOOSE)
    return frame


def _place(name: str, attrs: str, outer: int) -> int:
    """Where the content of an element stands: plain, in an article, or in a kind of frame."""
    marks, named, role, unseen = set(), 0, "", False
    for key, *values in ATTR.findall(attrs):
        key, value = key.lower(), html.unescape("".join(values))
        if key in ("class", "id"):
            marks.update(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
            named = max(named, _named(value))
        elif key == "role":
            role = value.strip().lower()
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and UNSEEN.search(value)):
            unseen = True
    if name in ("html", "body"):
        return PLAIN
    if unseen or outer == SEALED:
        return SEALED
    is_main_part = name == "main" or role == "main"
    if is_main_part or name == "article" or role == "article":
        if named == SEALED:
            return SEALED
        return outer if outer == FIRM and not is_main_part else IN_ARTICLE
    if named and outer == IN_ARTICLE and marks & {"article", "content", "entry", "post", "body"}:
        named = 0
    if name in FRAME or role in FRAME_ROLES or (name == "header" and outer != IN_ARTICLE):
        # Some pages are one form as a whole.
        named = max(named, LOOSE if name == "form" and role not in FRAME_ROLES else FIRM)
    return max(outer, named) if named or outer >= IN_FRAME else outer


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, words in links, place) of each block, in page order."""
    out: list[tuple[str, int, int, int]] = []
    run: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # name, place, whether its text is dropped
    last_end = {m[1].lower(): m.start() for m in DROPPED_END.finditer(page)}
    links = 0

    def close() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append((text, text.count(" ") + 1, len("".join(linked).split()), min(IN_FRAME, stack[-1][1]) if stack else PLAIN))
        run.clear(), linked.clear()

    def say(text: str) -> None:
        if text and not (stack and stack[-1][2]):
            text = html.unescape(text)
            run.append(text)
            if links:
                linked.append(text)

    at = 0
    for m in TOKEN.finditer(page):
        say(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name in BREAKS:
            say(" ")
        inner = bool(stack) and stack[-1][2]
        if inner and m["end"]:
            # Does it end something inside the dropped element, or the element itself?
            inner = next((d for x, _, d in reversed(stack) if x == name), True)
        if name in BLOCKS and not inner:
            close()
        if m["end"]:
            if name == "a":
                links = 0
                linked.append(" ")
            if any(x == name for x, _, _ in stack):
                while stack.pop()[0] != name:
                    pass
        elif name == "a":
            links = 1
        elif name not in VOID and not (name in ("html", "body") and stack):
            while stack and name in ENDS_BEFORE.get(stack[-1][0], ()):
                stack.pop()
            if name == "button" and any(x == name for x, _, _ in stack):  # buttons don't nest
                while stack.pop()[0] != name:
                    pass
            outer, within = stack[-1][1:] if stack else (PLAIN, False)
            if name in DROPPED:
                # What is never ended, and an svg that ends itself, is empty.
                if last_end.get(name, -1) >= at and not (name == "svg" and m["attrs"].endswith("/")):
                    stack.append((name, outer, True))
            elif name in BLOCKS or name == "span":
                stack.append((name, outer if within else _place(name, m["attrs"], outer), within))
    say(page[at:])
    close()
    return out


def main_text(page: str) -> str:
    """The main text of one page: its blocks, joined by line feeds."""
    found = blocks(page)
    sides = [(0.0, 0.0), *[(float(w), k / w) for _, w, k, _ in found], (0.0, 0.0)]
    kept = [
        text
        for i, (text, _, _, place) in enumerate(found)
        if is_main([*sides[i + 1], *sides[i], *sides[i + 2], float(place)])
    ]
    return "\n".join(kept)


def _extract(batches):
    for batch in slices(batches):
        texts = [main_text(x) for x in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars.

    Character references are decoded, white space in a block is one space, blocks
    are joined by one line feed. Null or empty pages and pages without main text
    give an empty text. Other columns are not read.
    """
    kinds = dict(pages.dtypes)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), whole(html_col).alias("html"))
    out = rows.mapInArrow(_extract, f"id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
