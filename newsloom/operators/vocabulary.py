"""Word counts, vocabularies, unknown-word marking and the train/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.tables import fixed_table
from newsloom.operators.lookup import LITERAL_VALUES, collect_bounded, lookup_join
from newsloom.operators.rows import explode_rows

MAX_WORDS = 10_000
UNKNOWN = "<unk>"


def word_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Occurrences of each word; counts combine before the shuffle."""
    return explode_rows(df, tokens, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_words(counts: DataFrame, size: int = MAX_WORDS) -> DataFrame:
    """Most frequent words, ties in word order."""
    return counts.orderBy(F.desc("n"), F.asc("word")).limit(size)


def mark_unknown(
    df: DataFrame, vocabulary: DataFrame, tokens: str = "tokens", unknown: str = UNKNOWN, id_col: str = "doc_id",
    max_values: int = LITERAL_VALUES,
) -> DataFrame:
    """Replace tokens outside the vocabulary, keeping order and length.

    A vocabulary of at most ``max_values`` words is read once and becomes a table
    inside the expression: no token is exploded or shuffled. A larger one is
    joined to the tokens by ``id_col``, which then must name each row.
    """
    words = collect_bounded(vocabulary, "word", max_values)
    if words is not None:
        known = fixed_table(dict.fromkeys(filter(None, words), True), "boolean")
        return df.withColumn(tokens, F.transform(tokens, lambda t: F.when(known(t), t).otherwise(F.lit(unknown))))
    each = explode_rows(df, tokens, "word", [id_col], pos="pos")
    found = lookup_join(each, vocabulary.select("word", F.lit(True).alias("_known")), "word", "left", spread_by=[id_col, "pos"])
    marked = F.struct("pos", F.when(F.col("_known"), F.col("word")).otherwise(F.lit(unknown)).alias("word"))
    lists = found.groupBy(id_col).agg(F.array_sort(F.collect_list(marked)).alias("_marked"))
    whole = F.coalesce(F.transform("_marked", lambda m: m["word"]), F.col(tokens))
    return df.join(lists, id_col, "left").withColumn(tokens, whole).select(*df.columns)


def oov_rate(df: DataFrame, tokens: str = "tokens", unknown: str = UNKNOWN) -> DataFrame:
    """Tokens, unknown tokens and their ratio, summed from per-row sizes."""
    size = F.size(F.coalesce(F.col(tokens), F.array().cast("array<string>")))
    missed = F.size(F.filter(F.coalesce(F.col(tokens), F.array().cast("array<string>")), lambda t: t == unknown))
    sums = df.agg(F.sum(size.cast("long")).alias("total"), F.sum(missed.cast("long")).alias("oov"))
    return sums.withColumn("rate", F.try_divide(F.col("oov").cast("double"), F.col("total")))


def split_bucket(id_col: str | Column, seed: int = 42) -> Column:
    """Bucket 0..99 from a hash of id and seed, the same on every run."""
    key = F.concat(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col, F.lit(f":{seed}"))
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(100)).cast("int")


def train_test_split(df: DataFrame, id_col: str = "doc_id", test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``; each row decides for itself, so nothing is shuffled."""
    cut = round((1 - test_share) * 100)
    return df.withColumn("split", F.when(split_bucket(id_col, seed) < cut, "train").otherwise("test"))
