"""TF-IDF keywords per article and over a selection of articles.

Term frequencies are counted inside the row of the article, and with the usual
number of features its keywords are found there as well. Only the corpus counts
per term are shuffled, combined before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.strings import let
from newsloom.functions.tables import fixed_table
from newsloom.operators.lookup import BROADCAST_ROWS, LITERAL_VALUES, collect_table, lookup_join
from newsloom.operators.rows import explode_rows
from newsloom.schemas import KEYWORDS
from newsloom.sources.staging import stage

MAX_FEATURES = 10_000
KEYWORDS_PER_ARTICLE = 10
LEADERBOARD_SIZE = 20
MIN_ARTICLES = 3
RANK_DIGITS = 9


def term_counts(tokens: str | Column) -> Column:
    """Array of (term, tf), by sorting the tokens and measuring the runs."""

    def run_starts(s: Column) -> Column:
        marked = F.transform(s, lambda t, i: F.when((i == 0) | (F.get(s, i - 1) != t), i))
        return F.filter(marked, lambda i: i.isNotNull())

    def runs(s: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda start, k: F.struct(
                F.get(s, start).alias("term"),
                (F.coalesce(F.get(starts, k + 1), F.size(s)) - start).alias("tf"),
            ),
        )

    ordered = F.sort_array(F.col(tokens) if isinstance(tokens, str) else tokens)
    return let(ordered, lambda s: let(run_starts(s), lambda starts: runs(s, starts)))


def with_terms(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Adds ``terms``, the (term, tf) pairs of the row; null tokens give null terms."""
    return df.withColumn("terms", term_counts(tokens))


def term_stats(df: DataFrame) -> DataFrame:
    """Occurrences ``n`` and document frequency ``df`` of every term."""
    return (
        explode_rows(df, "terms", "t")
        .groupBy(F.col("t.term").alias("term"))
        .agg(F.sum(F.col("t.tf").cast("long")).alias("n"), F.count(F.lit(1)).alias("df"))
    )


def term_idf(df: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The most frequent terms with ``idf = log10(N / df)``, in one scan.

    Every article also emits the empty term, which no tokeniser yields; its
    document frequency is N. It is ranked first, so the bounded top list holds
    N together with the features and the corpus is not scanned again to count.
    Articles whose ``terms`` are null (no text) do not count.
    """
    marker = F.array(F.struct(F.lit("").alias("term"), F.lit(1).alias("tf")))
    counted = df.select(F.concat(marker, "terms").alias("terms"))
    top = (
        term_stats(counted)
        .orderBy(F.desc(F.col("term") == ""), F.desc("n"), F.asc("term"))
        .limit(max_features + 1)
    )
    if max_features >= BROADCAST_ROWS:  # too many to meet in one row: the corpus size becomes a subquery
        top = stage(top, "features")
        docs = top.where("term = ''").select("df").scalar()
        return top.where("term <> ''").withColumn("idf", F.log10(docs / F.col("df")))
    # at most max_features + 1 rows meet here
    packed = top.agg(
        F.max(F.when(F.col("term") == "", F.col("df"))).alias("docs"),
        F.collect_list(F.when(F.col("term") != "", F.struct("term", "n", "df"))).alias("features"),
    )
    one = packed.select("docs", F.explode("features").alias("f")).select("docs", "f.*")
    return one.select("term", "n", "df", F.log10(F.col("docs") / F.col("df")).alias("idf"))


def weigh_terms(df: DataFrame, idf: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, term, tf, weight) for terms with an idf above zero."""
    weights = stage(idf.select("term", "idf"), "idf")
    pairs = explode_rows(df, "terms", "t", [id_col]).select(id_col, "t.term", "t.tf")
    return lookup_join(pairs, weights, "term", spread_by=[id_col]).select(
        id_col, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf")
    )


def rank_keywords(weighted: Column, k: int) -> Column:
    """L2-normalise an array of (word, weight) and keep the k best.

    Scores are compared to nine digits, so that rounding noise cannot decide
    between equal scores; ties go to the smaller word.
    """

    def ranked(norm: Column, sorted_weights: Column) -> Column:
        # only what may still be among the k best after rounding is rounded and sorted by word
        least = F.get(sorted_weights, F.least(F.lit(k), F.size(sorted_weights)) - 1) - norm * 10.0 ** (1 - RANK_DIGITS)
        keyed = F.transform(
            F.filter(weighted, lambda x: x["weight"] >= least),
            lambda x: F.struct(
                (-F.round(x["weight"] / norm, RANK_DIGITS)).alias("key"),
                x["word"].alias("word"),
                (x["weight"] / norm).alias("score"),
            ),
        )
        best = F.slice(F.sort_array(keyed), 1, k)
        return F.transform(best, lambda x: F.struct(x["word"].alias("word"), x["score"].alias("score")))

    norm = F.sqrt(F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x["weight"] * x["weight"]))
    weights = F.sort_array(F.transform(weighted, lambda x: x["weight"]), asc=False)
    return let(F.when(norm > 0, norm).otherwise(F.lit(1.0)), lambda n: let(weights, lambda w: ranked(n, w)))


def document_keywords(
    df: DataFrame, idf: DataFrame, k: int = KEYWORDS_PER_ARTICLE, id_col: str = "doc_id", in_row: int = LITERAL_VALUES
) -> DataFrame:
    """(id, keywords): the k terms of highest normalised TF-IDF per article.

    Articles without a weighted term keep an empty list. Weights of at most
    ``in_row`` terms become a table inside the expression, so that an article
    stays one row from its terms to its keywords and nothing is shuffled. More
    weights than that are joined to the terms, which meet again by article.
    """
    weights = stage(idf.select("term", "idf").where("idf > 0"), "idf")
    known = collect_table(weights, "term", "idf", in_row)
    if known is not None:
        weight_of = fixed_table(known, "double")
        terms = F.coalesce("terms", F.array().cast("array<struct<term:string,tf:int>>"))
        weighed = F.transform(terms, lambda t: F.struct(t["term"].alias("word"), (t["tf"] * weight_of(t["term"])).alias("weight")))
        weighted = F.filter(weighed, lambda w: w["weight"].isNotNull())
        return df.select(id_col, let(weighted, lambda w: rank_keywords(w, k)).cast(KEYWORDS).alias("keywords"))
    pairs = df.select(id_col, F.explode_outer("terms").alias("t")).select(id_col, "t.term", "t.tf")
    joined = lookup_join(pairs, weights, "term", "left", spread_by=[id_col])
    entry = F.when(
        F.col("idf") > 0,
        F.struct(F.col("term").alias("word"), (F.col("tf") * F.col("idf")).alias("weight")),
    )
    grouped = joined.groupBy(id_col).agg(F.collect_list(entry).alias("weighted"))
    return grouped.select(id_col, rank_keywords(F.col("weighted"), k).cast(KEYWORDS).alias("keywords"))


def explode_keywords(df: DataFrame, keywords: str = "keywords") -> DataFrame:
    """(word, score) of the complete keyword entries."""
    flat = explode_rows(df, keywords, "k").select("k.word", "k.score")
    return flat.where(F.col("word").isNotNull() & F.col("score").isNotNull())


def keyword_scores(df: DataFrame, keywords: str = "keywords") -> DataFrame:
    return explode_keywords(df, keywords).groupBy("word").agg(F.sum("score").alias("score"))


def leaderboard(scores: DataFrame, n: int = LEADERBOARD_SIZE) -> DataFrame:
    return scores.orderBy(F.desc(F.round("score", RANK_DIGITS)), F.asc("word")).limit(n)


def enough_articles(df: DataFrame, minimum: int = MIN_ARTICLES) -> bool:
    """Whether a selection is large enough for keywords; reads at most that many rows."""
    return len(df.select(F.lit(1)).limit(minimum).collect()) >= minimum
