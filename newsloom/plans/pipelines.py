"""The composed jobs: merge, resolve, label, keywords, explore, update, pages."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.cleaning import (
    clean_word_tokens, drop_stopwords, stopwords, with_clean, with_clean_geo, ws_tokens,
)
from newsloom.functions.dates import published_ts
from newsloom.functions.markup import (
    container, drop_hidden, html_to_text, is_page_url, main_text, min_words_gate, paragraph_text,
)
from newsloom.functions.strings import collapse_ws, let, nonblank, raw_text
from newsloom.operators import explore as ex
from newsloom.operators import filters as fl
from newsloom.operators import keywords as kw
from newsloom.operators import places as pl
from newsloom.operators import vocabulary as vo
from newsloom.operators.dedupe import feed_dedupe, new_only, union_sources, url_dedupe
from newsloom.operators.label_model import LabelModel, fit_label_model, label, probability_filter
from newsloom.operators.rules import AnyRule, active_rules, apply_rules
from newsloom.rules.dutch_sme import RULES
from newsloom.schemas import EVIDENCE
from newsloom.sources.readers import ORDER, read_article_json
from newsloom.sources.writers import stage


def merge_articles(spark: SparkSession, *dirs: str, extra: Sequence[DataFrame] = (), names: str = "*.json") -> DataFrame:
    """All article files and further sources, one row per address, first one kept.

    A further source that has no ``src_file`` and ``src_pos`` comes after the
    files and is numbered as it is read; give the columns where order matters.
    """
    frames = [read_article_json(spark, *dirs, names=names)] if dirs else []
    for number, frame in enumerate(extra):
        if not set(ORDER) <= set(frame.columns):
            frame = frame.withColumn("src_file", F.lit(f"~{number:04d}")).withColumn(
                "src_pos", F.monotonically_increasing_id()
            )
        frames.append(frame)
    return url_dedupe(union_sources(*frames), ORDER).drop(*ORDER)


def resolve_countries(
    df: DataFrame,
    lookup: DataFrame,
    threshold: float = pl.VOTE_THRESHOLD,
    id_col: str = "doc_id",
    candidates: Callable[[DataFrame], DataFrame] | None = None,
    blocked: list[str] | None = None,
) -> DataFrame:
    """Adds locations, country, country_score and country_evidence to all cleaned articles.

    Text stays out of the vote: only (id, mention) pairs are shuffled for it.
    """
    mentions = pl.location_mentions(df, lookup, "clean_geo", id_col, candidates, blocked)
    joined = df.join(pl.vote_countries(mentions, id_col, threshold), id_col, "left")
    return joined.withColumns(
        {
            "locations": F.coalesce("locations", F.array().cast("array<string>")),
            "country": F.coalesce("country", F.lit(pl.UNCERTAIN)),
            "country_score": F.coalesce("country_score", F.lit(0.0)),
            "country_evidence": F.coalesce("country_evidence", F.array().cast(EVIDENCE)),
        }
    )


def geo_resolve(
    df: DataFrame,
    lookup: DataFrame,
    min_conf: float = 0.6,
    threshold: float = pl.VOTE_THRESHOLD,
    id_col: str = "doc_id",
    normalize: bool = True,
    **hooks,
) -> DataFrame:
    """Articles resolved to a target country with at least ``min_conf``.

    ``hooks`` are the ``candidates`` and ``blocked`` of ``location_mentions``.
    """
    texts = with_clean_geo(df, raw_text(), normalize=normalize)
    mentions = pl.location_mentions(texts, lookup, "clean_geo", id_col, **hooks)
    votes = pl.country_filter(pl.vote_countries(mentions, id_col, threshold), min_conf)
    # the text is cleaned again for the articles that stay, not carried along for all
    return with_clean_geo(df.join(votes, id_col), raw_text(), normalize=normalize)


def weak_label(
    df: DataFrame,
    rules: Sequence[AnyRule] = RULES,
    min_conf: float = 0.6,
    model: LabelModel | None = None,
    text: str = "clean_geo",
    method: str = "steps",
) -> tuple[DataFrame, LabelModel]:
    """Votes, fit (unless a model is given) and probability of each article.

    Without a model the votes are staged with the article, so that the rules are
    applied once for the fit and the scoring.
    """
    votes = apply_rules(df, rules, text)
    if model is None:
        votes = stage(votes, "votes")
    fitted = model or fit_label_model(votes, rules, method=method)
    names = [r.name for r in active_rules(rules)]
    return label(votes, fitted, min_conf).drop(*names), fitted


def tokenized(
    df: DataFrame,
    stop: Sequence[str] | None = None,
    normalize: bool = True,
    tag_costs: dict[str, float] | None = None,
    id_col: str = "doc_id",
) -> DataFrame:
    """(id, terms) per article; terms are null when cleaning leaves no text.

    A null instead of a filter: a filter on the cleaned text would be pushed
    below the projection and clean every article twice.
    """
    words = stopwords() if stop is None else list(stop)
    cleaned = with_clean(df.select(id_col, raw_text().alias("clean")), "clean", "clean", normalize, tag_costs)
    tokens = F.when(F.col("clean") != "", drop_stopwords(clean_word_tokens("clean"), words))
    return kw.with_terms(cleaned.select(id_col, tokens.alias("tokens"))).select(id_col, "terms")


def word_tokens(
    df: DataFrame,
    size: int = vo.MAX_WORDS,
    test_share: float = 0.2,
    normalize: bool = True,
    id_col: str = "doc_id",
    tag_costs: dict[str, float] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(id, split, tokens) with rare words marked unknown, and the vocabulary used.

    The vocabulary is that of the training share. Tokens are staged, since the
    vocabulary has to be complete before the first of them can be marked.
    """
    cleaned = with_clean(df.select(id_col, raw_text().alias("clean")), "clean", "clean", normalize, tag_costs)
    tokens = vo.train_test_split(cleaned.select(id_col, ws_tokens("clean").alias("tokens")), id_col, test_share)
    tokens = stage(tokens, "tokens")
    vocabulary = vo.top_words(vo.word_counts(tokens.where("split = 'train'")), size)
    return vo.mark_unknown(tokens, vocabulary, id_col=id_col), vocabulary


def keywords(
    df: DataFrame,
    k: int = kw.KEYWORDS_PER_ARTICLE,
    max_features: int = kw.MAX_FEATURES,
    stop: Sequence[str] | None = None,
    fit_on: DataFrame | None = None,
    normalize: bool = True,
    id_col: str = "doc_id",
    staged: bool = True,
    tag_costs: dict[str, float] | None = None,
) -> DataFrame:
    """(id, keywords) per article. ``fit_on`` restricts what the idf is fitted to.

    The term counts feed both the fit and the scoring. They are much smaller
    than the text and costly to make, so they are staged once.
    """
    terms = tokenized(df, stop, normalize, tag_costs, id_col)
    if staged:
        terms = stage(terms, "terms")
    fitted = terms if fit_on is None else tokenized(fit_on, stop, normalize, tag_costs, id_col)
    return kw.document_keywords(terms, kw.term_idf(fitted, max_features), k, id_col)


def top_keywords(df: DataFrame, n: int = kw.LEADERBOARD_SIZE) -> DataFrame:
    return kw.leaderboard(kw.keyword_scores(df), n)


@dataclass(frozen=True)
class Exploration:
    articles: DataFrame
    weights: DataFrame
    titles: DataFrame
    spotlight: DataFrame
    keywords: DataFrame


def explore(
    df: DataFrame, spec: fl.FilterSpec, coordinates: DataFrame, region: DataFrame, staged: bool = True
) -> Exploration:
    """Everything the exploration view shows for one specification.

    The filtered articles feed four results, so they are staged once.
    """
    if "published_ts" not in df.columns and "published" in df.columns:
        df = df.withColumn("published_ts", published_ts("published"))
    kept = fl.apply_filters(df, spec)
    if staged:
        kept = stage(kept, "explore")
    mentions = ex.located_mentions(kept, coordinates)
    return Exploration(
        articles=kept,
        weights=ex.location_weights(mentions),
        titles=ex.location_titles(mentions),
        spotlight=ex.spotlight(kept, region),
        keywords=top_keywords(kept),
    )


def update_articles(existing: DataFrame, incoming: DataFrame, order: list[str], ts: str = "published_ts", late: str = "drop") -> DataFrame:
    """Stored articles plus the incoming ones that are new.

    With ``late="drop"`` incoming articles without a date, or older than the
    newest stored day, are not considered; with ``late="keep"`` all are.
    """
    if late not in ("drop", "keep"):
        raise ValueError("late must be 'drop' or 'keep'")
    if late == "drop":
        newest = existing.agg(F.date_trunc("day", F.max(ts)).alias("newest"))
        cutoff = F.coalesce(newest.scalar(), F.lit("0001-01-01").cast("timestamp"))
        incoming = incoming.where(F.col(ts) >= cutoff)
    return union_sources(existing, new_only(incoming, existing, order))


def pages_to_articles(pages: DataFrame, order: list[str], blank: str = "drop") -> DataFrame:
    """Raw pages to articles: feed (the host), title, url and main text, one per link."""
    host = F.lower(F.try_parse_url("url", F.lit("HOST")))
    # one projection per step: each result is used more than once by the next
    visible = pages.where(is_page_url("url")).select(*order, host.alias("feed"), "url", drop_hidden("html").alias("v"))
    blocks = visible.withColumn("main", main_text("v"))
    fallback = let(
        paragraph_text(container("v")), lambda t: F.when(nonblank(t), t).otherwise(paragraph_text("v"))
    )
    title = F.regexp_extract("v", r"(?is)<title[^>]*>(.*?)</title\s*>", 1)
    articles = blocks.select(
        *order,
        "feed",
        collapse_ws(html_to_text(title)).alias("title"),
        "url",
        collapse_ws(min_words_gate("main", fallback)).alias("full_text"),
    )
    return feed_dedupe(articles, order, blank=blank)


def enrich(
    df: DataFrame,
    lookup: DataFrame,
    rules: Sequence[AnyRule] = RULES,
    min_conf: float = 0.6,
    label_conf: float = 0.5,
    probability: float = 0.6,
    split: str | None = None,
    id_col: str = "doc_id",
    model: LabelModel | None = None,
    least_articles: int = 0,
    tag_costs: dict[str, float] | None = None,
) -> DataFrame:
    """The whole enrichment: country filter, label, probability filter, keywords.

    ``split='train'`` keeps the training share only, from which keywords are
    then fitted as well. Two tables are staged: the resolved articles, read
    by the fit and by the scoring, and the labelled selection. A selection of
    fewer than ``least_articles`` gets no keywords (by default any is enough).
    """
    resolved = stage(geo_resolve(df, lookup, min_conf, id_col=id_col), "resolved")
    labelled, _ = weak_label(resolved, rules, label_conf, model)
    selected = vo.train_test_split(probability_filter(labelled, probability), id_col)
    if split:
        selected = selected.where(F.col("split") == split)
    selected = stage(selected, "selected")
    if least_articles and not kw.enough_articles(selected, least_articles):
        none = F.array().cast("array<struct<word:string,score:double>>")
        return selected.withColumn("keywords", none)
    words = keywords(selected, id_col=id_col, tag_costs=tag_costs)
    empty = F.array().cast("array<struct<word:string,score:double>>")
    return selected.join(words, id_col, "left").withColumn("keywords", F.coalesce("keywords", empty))

