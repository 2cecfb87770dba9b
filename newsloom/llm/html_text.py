"""Main text of raw pages: flat text blocks, classified by a decision tree.

A page becomes a list of blocks, the texts between block-level tags. Each
carries its word count, its share of linked words, the same of the blocks
before and after, and where it stands: in the article, in a part whose tag or
name tells that it is something else, in a heading. A decision tree grown from
the labelled layouts of ``html_samples`` says which blocks are article. A page
is read in one pass of one pattern; no tree of the page is built.
"""

from __future__ import annotations

import html
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import pick
from newsloom.llm.html_samples import PAGES

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']*(?:"[^"]*"|'[^']*'))*[^>"']*|[^>]*)>|<[!?][^>]*>""", re.S
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul"
    " caption title button label select".split()
)
# Elements whose content is not text of the page.
# Elements that may end in their own tag.
FOREIGN = ("svg", "math")
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas audio video noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that hold something beside the article.
BESIDE = frozenset("nav footer aside form menu dialog button select option label fieldset head search".split())
INNER = frozenset(["article", "main"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
# Often left open, so they are remembered only if they say where a block stands.
PLAIN = frozenset(["li", "dd", "dt", "tr", "td", "th"])
# Words in names of classes and elements: what is never article, what is not unless the name also speaks of content, and content.
NEVER = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr comment comments disqus respond"
    " reply replies popup modal newsletter subscribe signup login share sharing social related recommended recommendations".split()
)
SELDOM = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead toolbar widget widgets notice notices banner copyright legal"
    " pagination pager search teaser teasers complementary contentinfo skip alert disclaimer tags".split()
)
CONTENT = frozenset("content article main post entry story body text prose".split())
FEATURES = (
    "words", "link_share", "words_before", "link_share_before", "words_after", "link_share_after", "beside", "inside", "heading", "item", "page_has_article",
)
DEPTH = 7


def _place(tag: str, attributes: str) -> tuple[int, int]:
    """(beside, inside) that an element says about what it holds."""
    beside, inside = int(tag in BESIDE), int(tag in INNER)
    if attributes and tag not in ("html", "body"):
        names = " ".join(a or b or c for a, b, c in NAMES.findall(attributes))
        if names:
            whole = names.lower().split()
            parts = set(whole) if inside else {p.lower() for p in PART.findall(names)}
            content = not parts.isdisjoint(CONTENT)
            if not parts.isdisjoint(NEVER) or (not content and not parts.isdisjoint(SELDOM)):
                beside = 1
            elif content and tag in ("div", "section", "td"):
                inside = 1
    return beside, inside


def _past(page: str, tag: str, at: int) -> int:
    """Where the element ends whose opening tag ends at ``at``; its text is left out.

    Drawings and formulas may be empty elements, hold elements of their own
    name, and end where they began if they are never closed.
    """
    if tag not in FOREIGN:
        end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
        return end.end() if end else len(page)
    if page[at - 2 : at] == "/>":
        return at
    depth = 1
    for m in re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.I).finditer(page, at):
        depth += -1 if m[1] else 0 if m[0].endswith("/>") else 1
        if not depth:
            return m.end()
    return at


def blocks_of(page: str) -> list[dict]:
    """The blocks of a page in order, without empty ones."""
    found: list[dict] = []
    stack: list[list] = []  # tag, beside, inside, header
    pieces: list[str] = []
    linked: list[str] = []
    links, heading, item = 0, 0, 0

    def close() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                beside = sum(e[1] for e in stack)
                inside = any(e[2] for e in stack)
                # a header belongs to the article only if it stands in one
                beside += any(e[3] for e in stack) and not inside
                found.append({
                    "text": text, "words": len(text.split()), "linked": len("".join(linked).split()), "beside": int(beside > 0),
                    "inside": int(inside and not beside), "heading": int(heading > 0), "item": int(item > 0),
                })
        pieces, linked = [], []

    def add(text: str) -> None:
        if text:
            if "&" in text:
                text = html.unescape(text)
            pieces.append(text)
            if links:
                linked.append(text + " ")

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if not m[1]:
            if tag in RAW:
                at = _past(page, tag, at)
                continue
            if tag == "br":
                pieces.append(" ")
            elif tag == "a":
                links = 1
            elif tag in BLOCKS:
                close()
                links = 0
                if stack and stack[-1][0] == "p":
                    stack.pop()
                if tag in HEADINGS:
                    heading = 1
                if tag == "li":
                    item = 1
                place = _place(tag, m[3])
                if tag not in VOID and tag not in HEADINGS and (tag not in PLAIN or any(place)):
                    stack.append([tag, *place, tag == "header"])
        elif tag == "a":
            links = 0
        elif tag in BLOCKS:
            close()
            if tag in HEADINGS:
                heading = 0
            if tag in ("li", "ul", "ol"):
                item = 0
            if tag != "p" and stack and stack[-1][0] == "p":
                stack.pop()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
    close()
    return found


def matrix_of(blocks: list[dict]) -> np.ndarray:
    """Features of the blocks of one page, in the order of FEATURES."""
    n = len(blocks)
    words = np.array([b["words"] for b in blocks], float)
    share = np.minimum(np.array([b["linked"] for b in blocks], float) / np.maximum(words, 1), 1)
    padded_words, padded_share = np.concatenate([[0], words, [0]]), np.concatenate([[0], share, [0]])
    marks = [[b[k] for b in blocks] for k in ("beside", "inside", "heading", "item")]
    has = np.full(n, float(any(b["inside"] for b in blocks)))
    return np.stack(
        [words, share, padded_words[:-2], padded_share[:-2], padded_words[2:], padded_share[2:], *(np.array(m, float) for m in marks), has], axis=1
    ) if n else np.zeros((0, len(FEATURES)))


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = DEPTH) -> tuple:
    """A leaf (label,) or a node (feature, cut, below, above); cuts lie midway and ties go to the first feature."""
    ones = y.sum()
    leaf = (int(2 * ones >= len(y)),)
    if depth == 0 or ones in (0, len(y)):
        return leaf
    best, chosen = len(y) * _gini(ones / len(y)) - 1e-9, None
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, j] < cut
            n = low.sum()
            cost = n * _gini(y[low].mean()) + (len(y) - n) * _gini(y[~low].mean())
            if cost < best:
                best, chosen = cost, (j, float(cut))
    if chosen is None:
        return leaf
    low = x[:, chosen[0]] < chosen[1]
    return (*chosen, grow_tree(x[low], y[low], depth - 1), grow_tree(x[~low], y[~low], depth - 1))


def _gini(p: float) -> float:
    return 2 * p * (1 - p)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in PAGES:
        blocks = blocks_of(page)
        for b in blocks:  # the mark is no word of the page
            b["words"] -= 1
            b["linked"] = min(b["linked"], b["words"])
        rows.append(matrix_of(blocks))
        labels += [b["text"][0] == "+" for b in blocks]
    return np.concatenate(rows), np.array(labels, float)


def classify(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0], bool)
    out = np.zeros(len(x), bool)
    low = x[:, tree[0]] < tree[1]
    for side, rows in ((tree[2], low), (tree[3], ~low)):
        if rows.any():
            out[rows] = classify(side, x[rows])
    return out


def main_text_of(page: str | None, tree: tuple) -> str:
    blocks = blocks_of(page or "")
    keep = classify(tree, matrix_of(blocks)) if blocks else []
    return "\n\n".join(b["text"] for b, k in zip(blocks, keep, strict=True) if k)


def main_text(page: Column) -> Column:
    """Article text of pages; null and empty pages give an empty text."""
    tree = grow_tree(*labelled_table())

    @F.arrow_udf("string")
    def text(pages: pa.Array) -> pa.Array:
        return pa.array([main_text_of(p, tree) for p in pages.to_pylist()], pa.string())

    return text(page)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; rows that repeat stay, other columns are ignored."""
    found = pick(pages, page_id=id_col, url=url_col, html=html_col).select("page_id", "url", main_text(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
