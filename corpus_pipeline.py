"""The corpus pipeline: five stages from raw documents to token files.

Each stage takes (session, the documents the stage before kept, folder of the
tables) and returns a DataFrame, which is written as Parquet and read again as
the documents of the next one. Stages one to four return the columns of
documents; the last one returns what its files hold.

Empty tables pass through every stage. Null texts count as empty texts: the
classifier scores them, they are near copies of each other, hold no benchmark
words, carry no tokens, and are encoded as the end id alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import mixing, quality
from newsloom.llm.common import scratch, table
from newsloom.llm.decontaminate import decontaminate
from newsloom.llm.simhash import drop_near_copies
from newsloom.llm.token_files import ids_crc32, read_tokens, tokenizer_path, write_tokens
from newsloom.sources.writers import stage

# Shares of the languages in the mixed tokens. No document that came this far
# is dropped: the least rate is one and the total is as small as that allows.
WEIGHTS = {"de": 0.2, "en": 0.4, "es": 0.2, "fr": 0.2}
LEAST_RATE = 1.0


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from all labels but the held-out ones."""
    labels = table(spark, folder, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    return quality.keep_good(docs, quality.train(table(spark, folder, "documents"), labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the smallest identifier."""
    return drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate(docs, table(spark, folder, "benchmark"))


def mix_languages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as their rate says, so that the languages' expected tokens meet the weights."""
    labelled = docs.select("doc_id", "lang").join(table(spark, folder, "labels").select("doc_id").distinct(), "doc_id")
    classifier = mixing.train(docs, labelled, sorted(WEIGHTS))
    members = stage(mixing.memberships(docs, classifier), "memberships")
    return mixing.mix_documents(docs, mixing.fit_rates(members, classifier, WEIGHTS, least=LEAST_RATE))


def write_token_files(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token files of the mixed documents, and what they hold for each: identifier, place, length and checksum."""
    path = scratch(spark, "pipeline-tokens")
    write_tokens(docs, path, tokenizer_path())
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", ids_crc32(F.col("ids")).alias("ids_crc32"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_to_weights", mix_languages),
    ("token_files", write_token_files),
]

# Fitted models, fingerprints and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, folder, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, folder), name)
    return docs


QUERIES = {"pipeline": run}
STATEMENTS = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
