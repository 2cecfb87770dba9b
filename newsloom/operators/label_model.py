"""Combining rule votes into one probability.

The model is the usual weak-supervision one: given the true class, rules vote
independently. Its parameters, the probability of each vote under each class,
are fitted to how often pairs of votes occur together. Spark computes those
pair counts in one aggregate; the rest works on a matrix whose size is the
number of rules, whatever the number of articles.

Published basis: Dawid & Skene (1979); Ratner et al., "Data Programming"
(2016) and "Training Complex Models with Multi-Task Weak Supervision" (2019); Fu et al.,
"Fast and Three-rious" (2020) for the closed form.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.rules import SME, AnyRule, indicators, vote_sums, _slot

# Length of the fit and the balanced class prior.
EPOCHS = 200
PRIOR = 0.5

START_PRECISION = 0.7
STEP = 0.05
# Covariances below this say nothing about a third vote.
LEAST_COVARIANCE = 1e-3


@dataclass(frozen=True)
class LabelModel:
    """Log-odds added by each vote, and the log-odds without any vote."""

    weights: tuple[tuple[str, int, float], ...]
    prior: float = PRIOR

    def log_odds(self) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, vote, weight in self.weights:
            total = total + F.when(F.col(rule) == vote, F.lit(weight)).otherwise(F.lit(0.0))
        return total

    def probability(self) -> Column:
        """P(SME | votes) over the vote columns; plain arithmetic, no UDF."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds()))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.weights), "rule string, vote int, weight double")


def pair_shares(votes: DataFrame, rules: Sequence[AnyRule]) -> tuple[np.ndarray, int]:
    """Matrix of joint vote shares and the number of articles, from one job."""
    cols = indicators(rules)
    row = vote_sums(votes, rules).first()
    n = int(row["n"])
    shares = np.zeros((len(cols), len(cols)))
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            shares[i, j] = shares[j, i] = row[_slot(a, cols[j])] / max(n, 1)
    return shares, n


def fit_vote_probabilities(
    shares: np.ndarray,
    votes: Sequence[int],
    owners: Sequence[str],
    n: int,
    prior: float = PRIOR,
    epochs: int = EPOCHS,
) -> np.ndarray:
    """P(vote | class) per indicator, columns NOT_SME and SME.

    Least squares on the joint shares of votes of different rules and on the
    single shares, by projected gradient steps from a better-than-chance
    start. The projection keeps every vote at least as likely under its own
    class, which also fixes which class is which.
    """
    classes = np.array([1.0 - prior, prior])
    votes = np.asarray(votes)
    single = np.diag(shares)
    other_rule = np.array([[a != b for b in owners] for a in owners], dtype=float)
    floor = 10.0 ** -max(2, math.ceil(math.log10(max(n, 10))))

    def project(mu: np.ndarray) -> np.ndarray:
        mu = np.clip(mu, floor, 1 - floor)
        rows = np.arange(len(votes))
        own, opposite = mu[rows, votes], mu[rows, 1 - votes]
        mean = (own + opposite) / 2
        worse = own < opposite
        mu[rows[worse], 0] = mu[rows[worse], 1] = mean[worse]
        return mu

    mu = np.empty((len(votes), 2))
    for i, v in enumerate(votes):
        mu[i, v] = single[i] * START_PRECISION / classes[v]
        mu[i, 1 - v] = single[i] * (1 - START_PRECISION) / classes[1 - v]
    mu = project(mu)
    for _ in range(epochs):
        joint_error = other_rule * ((mu * classes) @ mu.T - shares)
        single_error = mu @ classes - single
        gradient = 4 * joint_error @ (mu * classes) + 2 * np.outer(single_error, classes)
        mu = project(mu - STEP * gradient)
    return mu


def triplet_vote_probabilities(
    shares: np.ndarray, votes: Sequence[int], owners: Sequence[str], n: int, prior: float = PRIOR, least: float = LEAST_COVARIANCE
) -> np.ndarray:
    """P(vote | class) per indicator in closed form, columns NOT_SME and SME.

    Given the class, rules vote independently, so the covariance of two votes of
    different rules is the product of what the class adds to each, times the
    variance of the class. Three votes then give each of them alone:
    strength(i)^2 = cov(i, j) cov(i, k) / cov(j, k). The median over all pairs
    (j, k) with a covariance of at least ``least`` is taken; a vote without such
    a pair says nothing. A vote speaks for its own class.
    """
    classes = np.array([1.0 - prior, prior])
    single = np.diag(shares)
    covariance = shares - np.outer(single, single)
    floor = 10.0 ** -max(2, math.ceil(math.log10(max(n, 10))))
    mu = np.empty((len(votes), 2))
    for i, v in enumerate(votes):
        others = [j for j in range(len(votes)) if owners[j] != owners[i]]
        squares = [
            abs(covariance[i, j] * covariance[i, k] / covariance[j, k])
            for a, j in enumerate(others)
            for k in others[a + 1 :]
            if owners[j] != owners[k] and abs(covariance[j, k]) >= least
        ]
        # the difference of the two probabilities: covariance with a class of variance prior * (1 - prior)
        gap = math.sqrt(float(np.median(squares)) / (prior * (1 - prior))) if squares else 0.0
        mu[i, v] = single[i] + gap * classes[1 - v]
        mu[i, 1 - v] = single[i] - gap * classes[v]
    return np.clip(mu, floor, 1 - floor)


def fit_label_model(
    votes: DataFrame, rules: Sequence[AnyRule], prior: float = PRIOR, epochs: int = EPOCHS, method: str = "steps"
) -> LabelModel:
    """Weights from one aggregate of pair counts, by gradient ``steps`` or in closed form from ``triplets``."""
    if method not in ("steps", "triplets"):
        raise ValueError("the method is 'steps' or 'triplets'")
    cols = indicators(rules)
    shares, n = pair_shares(votes, rules)
    polarity, owners = [v for _, v in cols], [r for r, _ in cols]
    if method == "triplets":
        mu = triplet_vote_probabilities(shares, polarity, owners, n, prior)
    else:
        mu = fit_vote_probabilities(shares, polarity, owners, n, prior, epochs)
    weights = [
        # a vote never seen says nothing
        (rule, vote, float(math.log(mu[i, 1] / mu[i, 0])) if shares[i, i] > 0 else 0.0)
        for i, (rule, vote) in enumerate(cols)
    ]
    return LabelModel(tuple(weights), prior)


def label(df: DataFrame, model: LabelModel, min_conf: float = 0.6) -> DataFrame:
    """Adds sme_probability and sme_label (probability at least ``min_conf``)."""
    scored = df.withColumn("sme_probability", model.probability())
    return scored.withColumn("sme_label", (F.col("sme_probability") >= min_conf).cast("int"))


def probability_filter(df: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Strictly above the threshold."""
    return df.where(F.col("sme_probability") > threshold)


__all__ = ["SME", "LabelModel", "fit_label_model", "fit_vote_probabilities", "label", "pair_shares", "probability_filter", "triplet_vote_probabilities"]
