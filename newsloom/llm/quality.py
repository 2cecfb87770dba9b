"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a few numbers about its letters, words and lines. Cyclic
boosting adds a shallow tree per feature and round, each fitted to what is still
unexplained; a feature's trees add up to one lookup table over its bins. The
pairs that explain most of the rest get tables of their own, boosted the same
way. A score is the logistic of the intercept and the looked-up table entries.

The model is fitted on a bounded sample of labelled rows; scoring is one pass
over the texts with no shuffle.
"""

from __future__ import annotations

import sys
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import pick, quoted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Labelled rows the fit may see. The rows with the smallest hash of their
# identifier are taken, so the sample depends neither on order nor on layout.
SAMPLE = 20_000
THRESHOLD = 0.7
BINS = 24
ROUNDS = 150
PAIRS = 6
PAIR_BINS = 8
PAIR_ROUNDS = 40
RATE = 0.1
LEAST_ROWS = 5
FEATURES = (
    "log_bytes", "log_words", "letters", "upper", "digits", "symbols", "punctuation", "other_bytes", "word_length",
    "distinct_words", "top_word", "same_as_last", "marked_words", "bare_symbols", "line_words", "ended_lines", "same_lines",
    "distinct_pairs",
)
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
PUNCTUATION = np.isin(np.arange(256), list(b".,;:?'\"()-"))
SYMBOL = np.array([33 <= c < 127 and not chr(c).isalnum() and not PUNCTUATION[c] for c in range(256)])
MARKS = frozenset(np.flatnonzero(SYMBOL).tolist())
BARE = bytes(np.flatnonzero(SYMBOL | PUNCTUATION).tolist())

Model = dict


def features_of(data: bytes) -> list[float]:
    """Numbers in the order of FEATURES; all are zero for a text without bytes."""
    if not data:
        return [0.0] * len(FEATURES)
    n = len(data)
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    count = len(words) or 1
    letters = int(seen[LETTER].sum())
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    counts = Counter(words)
    marked = sum(w[-1] in MARKS for w in words)
    bare = sum(not w.strip(BARE) for w in words)
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = [x for x in data.split(b"\n") if x.strip()]
    lined = len(lines) or 1
    ended = sum(x.rstrip()[-1:] in (b".", b"!", b"?", b":", b'"') for x in lines)
    pairs = set(zip(words, words[1:], strict=False))
    return [
        float(np.log1p(n)), float(np.log1p(len(words))), letters / n, upper / max(1, upper + lower),
        int(seen[48:58].sum()) / n, int(seen[SYMBOL].sum()) / n, int(seen[PUNCTUATION].sum()) / n, int(seen[128:].sum()) / n,
        sum(map(len, words)) / count, len(counts) / count, max(counts.values(), default=0) / count, same / count, marked / count,
        bare / count, min(count / lined, 1000.0), ended / lined, 1 - len(set(lines)) / lined, len(pairs) / max(1, len(words) - 1),
    ]


def bin_edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Inner borders of about equally filled bins; fewer where values repeat."""
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher")) if len(x) else np.zeros(0)


def _tree(grad: np.ndarray, weight: np.ndarray, rows: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Newton steps of a tree with few leaves over ordered bins, one value per bin."""
    cuts = [0, len(grad)]
    g, h, n = (np.concatenate([[0], np.cumsum(v)]) for v in (grad, weight, rows))

    def gain(a: int, b: int) -> float:
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)

    for _ in range(leaves - 1):
        best, at = 1e-9, None
        for a, b in zip(cuts, cuts[1:], strict=False):
            for m in range(a + 1, b):
                if n[m] - n[a] >= LEAST_ROWS and n[b] - n[m] >= LEAST_ROWS:
                    won = gain(a, m) + gain(m, b) - gain(a, b)
                    if won > best:
                        best, at = won, m
        if at is None:
            break
        cuts = sorted([*cuts, at])
    out = np.zeros(len(grad))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _pair_tree(grad: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """The best four-leaf tree over two binned features: one cut of the first, one of the second on either side."""
    best, out = 0.0, np.zeros(grad.shape)

    def halves(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        g, h = g.sum(axis=0), h.sum(axis=0)
        a, c = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        if not len(a):
            return g.sum() ** 2 / (h.sum() + 1.0), np.full(len(g), g.sum() / (h.sum() + 1.0))
        won = a**2 / (c + 1.0) + (g.sum() - a) ** 2 / (h.sum() - c + 1.0)
        m = int(won.argmax())
        values = np.where(np.arange(len(g)) <= m, a[m] / (c[m] + 1.0), (g.sum() - a[m]) / (h.sum() - c[m] + 1.0))
        return float(won[m]), values

    for m in range(1, len(grad)):
        (low, left), (high, right) = halves(grad[:m], weight[:m]), halves(grad[m:], weight[m:])
        if low + high > best:
            best = low + high
            out = np.where(np.arange(len(grad))[:, None] < m, left, right)
    return out, best


def fit_model(x: np.ndarray, y: np.ndarray) -> Model:
    """Boosted tables for 0/1 labels; without rows of both labels the score is the share of ones (0.5 if none)."""
    n = len(y)
    share = (float(y.sum()) + 0.5) / (n + 1.0) if n else 0.5
    edges = [bin_edges(x[:, j], BINS) for j in range(x.shape[1])] if n else [np.zeros(0)] * len(FEATURES)
    tables = [np.zeros(len(e) + 1) for e in edges]
    model: Model = {"intercept": float(np.log(share / (1 - share))), "edges": edges, "tables": tables, "pairs": []}
    if n == 0 or y.min() == y.max():
        return model
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    sizes = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, tables, strict=True)]
    raw = np.full(n, model["intercept"])

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-raw))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for b, t, size in zip(bins, tables, sizes, strict=True):
            grad, weight = residual()
            step = RATE * _tree(np.bincount(b, grad, len(t)), np.bincount(b, weight, len(t)), size)
            t += step
            raw += step[b]
    coarse_edges = [bin_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse_edges)]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        grad, weight = residual()
        shape = (len(coarse_edges[i]) + 1, len(coarse_edges[j]) + 1)
        cell = coarse[i] * shape[1] + coarse[j]
        return tuple(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (grad, weight))

    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda p: -_pair_tree(*sums(*p))[1])
    chosen = [(i, j, np.zeros((len(coarse_edges[i]) + 1, len(coarse_edges[j]) + 1))) for i, j in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, t in chosen:
            step = RATE * _pair_tree(*sums(i, j))[0]
            t += step
            raw += step[coarse[i], coarse[j]]
    model["pairs"] = [(i, j, coarse_edges[i], coarse_edges[j], t) for i, j, t in chosen]
    return model


def score_rows(model: Model, x: np.ndarray) -> np.ndarray:
    """Probabilities of label 1: the sum of the table entries of every row's bins."""
    raw = np.full(len(x), model["intercept"])
    for j, (e, t) in enumerate(zip(model["edges"], model["tables"], strict=True)):
        raw += t[np.searchsorted(e, x[:, j], side="right")]
    for i, j, a, b, t in model["pairs"]:
        raw += t[np.searchsorted(a, x[:, i], side="right"), np.searchsorted(b, x[:, j], side="right")]
    return 1 / (1 + np.exp(-raw))


def _matrix(texts: pa.Array) -> np.ndarray:
    rows = [features_of(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


def score_column(model: Model, text: Column) -> Column:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(score_rows(model, _matrix(texts)), pa.float64())

    return score(text)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows that have a document.

    Rows with a null identifier or a label other than 0 or 1 are left out. A
    label row that repeats counts once; an identifier with both labels counts
    with both. Without labels the model scores 0.5 everywhere.
    """
    usable = pick(labels, id=id_col, label=label_col).where(F.col("id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    # hashes below a share of their range bring the rows near the bound before any task sorts them
    n = usable.count()
    rank = F.xxhash64(F.col("id").cast("string"))
    below = int(-(2**63) + 2**64 * min(1.0, 1.2 * sample / max(n, 1)))
    if below < 2**63:
        usable = usable.where(rank < F.lit(below))
    chosen = usable.orderBy(rank, "id", "label").limit(sample)
    texts = pick(docs, id=id_col, text=text_col)

    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        return pa.array(_matrix(texts).tolist(), pa.list_(pa.float64()))

    # at most ``sample`` identifiers are broadcast
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", features("text").alias("x")).orderBy("id", "label", "x").limit(sample).collect()
    x = np.array([r["x"] for r in rows], np.float64).reshape(len(rows), len(FEATURES))
    return fit_model(x, np.array([r["label"] for r in rows], np.float64))


def with_quality(docs: DataFrame, model: Model, into: str = "quality_score", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and the score; a column of that name is replaced. Null texts count as empty."""
    return docs.withColumn(into, score_column(model, F.col(quoted(text_col))))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents whose score reaches the threshold, with their own columns."""
    return docs.where(score_column(model, F.col(quoted(text_col))) >= threshold)
