"""Rules, votes and the label model."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from newsloom.catalog import inputs as src
from newsloom.catalog.registry import query
from newsloom.operators import label_model as lm
from newsloom.operators import rules as ru
from newsloom.plans import pipelines as pl
from newsloom.rules.dutch_sme import RULES

ALL_DUTCH = tuple(dataclasses.replace(r, active=True) for r in RULES)
NAMES = [r.name for r in ru.active_rules(src.WORD_RULES)]
MODEL = lm.LabelModel(src.RULE_WEIGHTS, prior=0.4)


def _texts(spark, folder):
    docs = src.spread(src.table(spark, folder, "documents"), "doc_id")
    return docs.select("doc_id", F.col("text").alias("clean_geo"))


def _votes(spark, folder, rules=src.WORD_RULES):
    return ru.apply_rules(_texts(spark, folder), rules).drop("clean_geo")


VOTES = src.votes_sql()
LOG_ODDS = "ln(0.4::DOUBLE / 0.6::DOUBLE) + " + " + ".join(
    f"CASE WHEN {r} = {v} THEN {w}::DOUBLE ELSE 0.0::DOUBLE END" for r, v, w in src.RULE_WEIGHTS)
SCORED = f"{VOTES},\nscored AS (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({LOG_ODDS}))) AS p FROM votes)"


@query("rule_votes", f"WITH {VOTES} SELECT * FROM votes")
def rule_votes(spark, folder):
    return _votes(spark, folder)


@query("dutch_rule_votes", f"WITH {src.votes_sql(ALL_DUTCH)} SELECT * FROM votes")
def dutch_rule_votes(spark, folder):
    """All twelve Dutch rules, the two inactive ones included."""
    return _votes(spark, folder, ALL_DUTCH)


@query("lf_coverage", f"WITH {VOTES} " + " UNION ALL ".join(
    f"SELECT '{r}' AS rule, round(avg(({r} <> -1)::INTEGER), 9) AS coverage, round(avg(({r} = 1)::INTEGER), 9) AS sme, "
    f"round(avg(({r} = 0)::INTEGER), 9) AS not_sme FROM votes" for r in NAMES))
def lf_coverage(spark, folder):
    shares = ru.rule_coverage(_votes(spark, folder), src.WORD_RULES)
    return shares.select("rule", *[F.round(c, 9).alias(c) for c in ("coverage", "sme", "not_sme")])


PAIRS = [(a, b) for i, a in enumerate(ru.indicators(src.WORD_RULES)) for b in ru.indicators(src.WORD_RULES)[i:]]


@query("vote_moments", f"WITH {VOTES} " + " UNION ALL ".join(
    f"SELECT '{a}' AS rule_a, {x} AS vote_a, '{b}' AS rule_b, {y} AS vote_b, "
    f"round(avg(({a} = {x} AND {b} = {y})::INTEGER), 9) AS share FROM votes" for (a, x), (b, y) in PAIRS))
def vote_moments(spark, folder):
    return ru.vote_moments(_votes(spark, folder), src.WORD_RULES).withColumn("share", F.round("share", 9))


@query("majority_vote", f"""
WITH {VOTES}, b AS (SELECT doc_id, {" + ".join(f"CASE {r} WHEN 1 THEN 1 WHEN 0 THEN -1 ELSE 0 END" for r in NAMES)} AS balance FROM votes)
SELECT doc_id, CASE WHEN balance > 0 THEN 1 WHEN balance < 0 THEN 0 ELSE -1 END AS label FROM b""")
def majority_vote(spark, folder):
    return _votes(spark, folder).select("doc_id", ru.majority_vote(src.WORD_RULES).alias("label"))


@query("posterior_fixed_weights", f"WITH {SCORED} SELECT doc_id, round(p, 9) AS sme_probability FROM scored")
def posterior_fixed_weights(spark, folder):
    return _votes(spark, folder).select("doc_id", F.round(MODEL.probability(), 9).alias("sme_probability"))


@query("threshold_label", f"WITH {SCORED} SELECT doc_id, (p >= 0.5)::INTEGER AS sme_label FROM scored")
def threshold_label(spark, folder):
    return lm.label(_votes(spark, folder), MODEL, 0.5).select("doc_id", "sme_label")


@query("prob_threshold", f"WITH {SCORED} SELECT doc_id, round(p, 9) AS sme_probability FROM scored WHERE p > 0.6")
def prob_threshold(spark, folder):
    kept = lm.probability_filter(lm.label(_votes(spark, folder), MODEL))
    return kept.select("doc_id", F.round("sme_probability", 9).alias("sme_probability"))


@query("weak_label_fixed", f"""
WITH {SCORED} SELECT doc_id, round(p, 9) AS sme_probability, (p >= 0.6)::INTEGER AS sme_label FROM scored""")
def weak_label_fixed(spark, folder):
    labelled, _ = pl.weak_label(_texts(spark, folder), src.WORD_RULES, model=MODEL)
    return labelled.select("doc_id", F.round("sme_probability", 9).alias("sme_probability"), "sme_label")


@query("label_model_fit")
def label_model_fit(spark, folder):
    """Weights fitted to the vote statistics of all documents; an iterative fit, so no SQL."""
    return lm.fit_label_model(_votes(spark, folder), src.WORD_RULES).to_frame(spark)


@query("weak_label")
def weak_label(spark, folder):
    """Label and probability from a fitted model; depends on the fit, so no SQL."""
    labelled, _ = pl.weak_label(_texts(spark, folder), src.WORD_RULES)
    return labelled.select("doc_id", "sme_probability", "sme_label")


# The closed form: covariances of votes of different rules, and the median over triplets of them.
IND = ru.indicators(src.WORD_RULES)
TRIPLETS = f"""{VOTES},
ind(rule, vote) AS (VALUES {", ".join(f"('{r}', {v})" for r, v in IND)}),
total AS (SELECT count(*)::DOUBLE AS n FROM votes),
single AS (""" + " UNION ALL ".join(f"SELECT '{r}' AS rule, {v} AS vote, count(*) FILTER ({r} = {v}) / count(*)::DOUBLE AS s FROM votes" for r, v in IND) + """),
joint AS (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS ra, {x} AS va, '{b}' AS rb, {y} AS vb, count(*) FILTER ({a} = {x} AND {b} = {y}) / count(*)::DOUBLE AS share FROM votes"
    for a, x in IND for b, y in IND if a != b) + f"""),
cov AS (SELECT ra, va, rb, vb, share - p.s * q.s AS c FROM joint
  JOIN single p ON p.rule = ra AND p.vote = va JOIN single q ON q.rule = rb AND q.vote = vb),
squares AS (SELECT x.ra AS rule, x.va AS vote, abs(x.c * y.c / z.c) AS sq
  FROM cov x JOIN cov y ON x.ra = y.ra AND x.va = y.va AND (x.rb, x.vb) < (y.rb, y.vb)
  JOIN cov z ON z.ra = x.rb AND z.va = x.vb AND z.rb = y.rb AND z.vb = y.vb WHERE abs(z.c) >= {lm.LEAST_COVARIANCE}),
gaps AS (SELECT rule, vote, s, coalesce(sqrt(median(sq) / 0.25::DOUBLE), 0) AS gap
  FROM single LEFT JOIN squares USING (rule, vote) GROUP BY rule, vote, s),
bounded AS (SELECT *, power(10.0::DOUBLE, -greatest(2, ceil(log10(greatest(n, 10))))) AS least FROM gaps, total),
mu AS (SELECT rule, vote, s, least(greatest(s + gap / 2, least), 1 - least) AS own, least(greatest(s - gap / 2, least), 1 - least) AS other FROM bounded),
weights AS (SELECT rule, vote, CASE WHEN s = 0 THEN 0.0 WHEN vote = 1 THEN ln(own / other) ELSE ln(other / own) END AS weight FROM mu)"""


@query("label_model_triplets", f"WITH {TRIPLETS} SELECT rule, vote, round(weight, 6) AS weight FROM weights")
def label_model_triplets(spark, folder):
    """Weights in closed form from the vote statistics of all documents."""
    model = lm.fit_label_model(_votes(spark, folder), src.WORD_RULES, method="triplets")
    return model.to_frame(spark).withColumn("weight", F.round("weight", 6))


@query("weak_label_triplets", f"WITH {TRIPLETS}, odds AS (SELECT doc_id, " + " + ".join(
    f"CASE WHEN {r} = {v} THEN (SELECT weight FROM weights WHERE rule = '{r}' AND vote = {v}) ELSE 0 END" for r, v in IND) + """ AS o FROM votes)
SELECT doc_id, round(1 / (1 + exp(-o)), 6) AS sme_probability FROM odds""")
def weak_label_triplets(spark, folder):
    """Every document scored with the closed form fitted to all of them."""
    labelled, _ = pl.weak_label(_texts(spark, folder), src.WORD_RULES, method="triplets")
    return labelled.select("doc_id", F.round("sme_probability", 6).alias("sme_probability"))
