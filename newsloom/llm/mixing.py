"""Mixing documents to target weights of domains, with soft membership.

A naive-Bayes classifier, counted on labelled rows, gives every document a
posterior over the domains. Rates per document are then fitted so that the
expected tokens of every domain, rate times tokens times posterior summed over
all documents, meet the targets: least squares by projected gradient steps. A
step needs only the domain totals, one small aggregate over the corpus; the
rate of a document is a function of its own posterior and of the steps so far,
so no table of rates has to be kept or joined.

Everything that touches documents is a DataFrame or SQL function. The driver
holds numbers per domain and per word of the classifier, both bounded.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import WHITE, fresh, pick, quoted
from newsloom.sources.writers import stage

# Labelled documents the classifier is counted on, by smallest hash of their identifier.
SAMPLE = 20_000
WORDS = 128
# Posteriors of naive Bayes are too sure; log-odds are scaled by this.
TEMPER = 0.25
STEPS = 40
# Shares of the total: targets count as met at the first, totals as settled at the second.
TOLERANCE = 1e-4
STILL = 1e-9


@dataclass
class Classifier:
    domains: list[str]
    base: list[float]
    weights: dict[str, list[float]] = field(default_factory=dict)


@dataclass
class Mix:
    classifier: Classifier
    least: float
    most: float
    start: float
    steps: list[list[float]]
    totals: dict[str, float]
    targets: dict[str, float]

    def missed(self) -> dict[str, float]:
        """Domains whose totals are off, and by how many tokens; empty if all targets are met."""
        off = {x: self.totals[x] - t for x, t in self.targets.items()}
        return {x: v for x, v in off.items() if abs(v) > TOLERANCE * max(sum(self.targets.values()), 1.0)}


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WHITE), lambda w: w != "")


def train(
    docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang",
    sample: int = SAMPLE, words: int = WORDS,
) -> Classifier:
    """Count which words the documents of ``labelled`` (``id, domain``) hold.

    Rows with null in either column or a domain not asked for are left out;
    without any, every posterior is even. Ties between words go to the first in order.
    """
    usable = pick(labelled, id=id_col, domain=domain_col).where(F.col("id").isNotNull() & F.col("domain").isin(domains)).distinct()
    rank = F.xxhash64(F.col("id").cast("string"))
    below = int(-(2**63) + 2**64 * min(1.0, sample / max(usable.count(), 1)))
    if below < 2**63:
        usable = usable.where(rank < F.lit(below))
    # rows in the sample follow the hash, so their number is close to the bound at any size
    rows = stage(
        pick(docs, id=id_col, text=text_col).join(usable, "id").select("domain", F.array_distinct(words_of(F.col("text"))).alias("words")), "labelled-words"
    )
    sizes = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n = [sizes.get(d, 0) for d in domains]
    share = [(F.count_if(F.col("domain") == d) + 0.5) / (k + 1.0) for d, k in zip(domains, n, strict=True)]
    chosen = (
        rows.select("domain", F.explode("words").alias("word"))
        .groupBy("word").agg(*[s.alias(f"s{i}") for i, s in enumerate(share)])
        .withColumn("spread", F.greatest(*[f"s{i}" for i in range(len(n))]) - F.least(*[f"s{i}" for i in range(len(n))]))
        .orderBy(F.desc("spread"), "word").limit(words).collect()
        if len(domains) > 1 else []
    )
    base = np.log((np.array(n) + 1.0) / (sum(n) + len(n)))
    weights = {}
    for r in chosen:
        p = np.array([r[f"s{i}"] for i in range(len(n))])
        base = base + np.log1p(-p)
        weights[r["word"]] = (np.log(p) - np.log1p(-p)).tolist()
    return Classifier(domains, base.tolist(), weights)


def _numbers(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def posterior(classifier: Classifier, words: Column) -> Column:
    """Array of posteriors, in the order of the domains."""
    scores = _numbers(classifier.base)
    if classifier.weights:
        table = F.create_map(*[x for w, v in classifier.weights.items() for x in (F.lit(w), _numbers(v))])
        found = F.array_intersect(F.array(*[F.lit(w) for w in classifier.weights]), words)
        scores = F.aggregate(found, scores, lambda sums, w: F.zip_with(sums, F.element_at(table, w), lambda a, b: a + b))
    raised = F.transform(F.array(scores), lambda s: F.transform(s, lambda v: F.exp((v - F.array_max(s)) * TEMPER)))
    return F.transform(raised, lambda s: F.transform(s, lambda v: v / F.aggregate(s, F.lit(0.0), lambda a, b: a + b)))[0]


def _rate(p: Column, mix_steps: list[list[float]], start: float, least: float, most: float) -> Column:
    if not mix_steps:
        return F.lit(float(min(most, max(least, start))))
    steps = F.array(*[_numbers(g) for g in mix_steps])

    def step(rate: Column, g: Column) -> Column:
        move = F.aggregate(F.zip_with(p, g, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        return F.greatest(F.lit(least), F.least(F.lit(most), rate - move))

    return F.aggregate(steps, F.lit(float(start)), step)


def memberships(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, p``: tokens are words between ASCII white space."""
    words = pick(docs, doc_id=id_col, text=text_col).select("doc_id", words_of(F.col("text")).alias("words"))
    return words.select("doc_id", F.size("words").cast("long").alias("n_tokens"), posterior(classifier, F.col("words")).alias("p"))


def fit_rates(
    members: DataFrame, classifier: Classifier, weights: dict[str, float], total: float | None = None, least: float = 0.0, most: float = math.inf
) -> Mix:
    """Rates of ``least`` at least, and at most ``most`` if it is given, whose expected domain totals come closest to ``weights`` times ``total``.

    ``total`` is the corpus itself if it is not given; with ``least`` of one or
    more it is the smallest total for which no domain has to shrink. The steps
    are gradient steps of the squared distance of the totals, measured so that a
    step of length one suits every domain, and projected on the bounds; only
    documents within the bounds are measured, unless that leads too far. They
    end when the totals fit or no longer move: targets out of reach stay missed,
    which is told by a warning and by ``missed``.
    """
    domains, d = classifier.domains, len(classifier.domains)
    share = np.array([weights[x] for x in domains], float)
    if (share < 0).any() or share.sum() <= 0 or least < 0 or most < least:
        raise ValueError("weights and bounds are not negative, and some weight is positive")
    share = share / share.sum()
    at = [F.get("p", F.lit(i)) for i in range(d)]
    tokens = F.col("n_tokens")
    cells = [(i, j) for i in range(d) for j in range(i, d)]
    row = members.agg(
        F.sum(tokens).alias("n"), *[F.sum(tokens * at[i]).alias(f"a{i}") for i in range(d)], *[F.sum(tokens * at[i] * at[j]).alias(f"m{i}_{j}") for i, j in cells]
    ).first()
    have = np.array([row[f"a{i}"] or 0.0 for i in range(d)])
    metric = np.zeros((d, d))
    for i, j in cells:
        metric[i, j] = metric[j, i] = row[f"m{i}_{j}"] or 0.0
    if total is None:
        total = float(row["n"] or 0)
        if least >= 1:
            total = float(max((least * h / s for h, s in zip(have, share, strict=True) if s > 0), default=0.0))
    targets, inverse = share * total, np.linalg.pinv(metric, hermitian=True)
    start = min(most, max(least, total / row["n"])) if row["n"] else least
    steps, totals, free = [], have * start, inverse
    gap = totals - targets
    for _ in range(STEPS):
        if np.abs(gap).max() <= TOLERANCE * max(total, 1.0):
            break
        tried = [*steps, (free @ gap).tolist()]
        rated = members.select("n_tokens", "p", _rate(F.col("p"), tried, start, least, most).alias("rate"))
        moving = (F.col("rate") > least) & (F.col("rate") < most)
        got = rated.agg(
            *[F.sum(tokens * F.col("rate") * at[i]).alias(f"a{i}") for i in range(d)],
            *[F.sum(F.when(moving, tokens * at[i] * at[j])).alias(f"m{i}_{j}") for i, j in cells],
        ).first()
        after = np.array([got[f"a{i}"] or 0.0 for i in range(d)])
        moved, closer = np.abs(after - totals).max(), (after - targets) @ inverse @ (after - targets) < gap @ inverse @ gap
        if free is not inverse and not closer:
            free = inverse  # too far: the same step again, as the whole corpus measures it
            continue
        settled = free is inverse and moved <= STILL * max(total, 1.0)
        steps, totals, gap = tried, after, after - targets
        if settled:
            break
        part = np.zeros((d, d))
        for i, j in cells:
            part[i, j] = part[j, i] = got[f"m{i}_{j}"] or 0.0
        # a part without room for some direction, or a step that hardly moved, is measured by the whole corpus
        roomy = np.linalg.eigvalsh(part).min() > 1e-6 * max(np.linalg.eigvalsh(metric).max(), 1e-300)
        free = np.linalg.inv(part) if roomy and moved > STILL * max(total, 1.0) else inverse
    mix = Mix(classifier, least, most, start, steps, dict(zip(domains, totals.tolist(), strict=True)), dict(zip(domains, targets.tolist(), strict=True)))
    if mix.missed():
        warnings.warn(f"targets of the mix are missed: totals {mix.totals}, targets {mix.targets}", stacklevel=2)
    return mix


def with_rates(members: DataFrame, mix: Mix, seed: int = 0) -> DataFrame:
    """``members`` with ``rate`` and ``copies``: the whole part of the rate, and one more with the chance of the rest."""
    rated = members.withColumn("rate", _rate(F.col("p"), mix.steps, mix.start, mix.least, mix.most))
    return rated.withColumn("copies", _copies(F.col("rate"), F.col("doc_id"), seed))


def _copies(rate: Column, doc_id: Column, seed: int) -> Column:
    chance = F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("int")


def mix_documents(docs: DataFrame, mix: Mix, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as its rate says, with their own columns; no shuffle."""
    copies = fresh(docs)
    # held as lambda variables, so that words and posterior are worked out once a row
    rate = F.transform(
        F.transform(F.array(words_of(F.col(quoted(text_col)))), lambda w: posterior(mix.classifier, w)),
        lambda p: _rate(p, mix.steps, mix.start, mix.least, mix.most),
    )[0]
    counted = docs.withColumn(copies, _copies(rate, F.col(quoted(id_col)), seed)).where(F.col(copies) > 0)
    return counted.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[quoted(c) for c in docs.columns])
