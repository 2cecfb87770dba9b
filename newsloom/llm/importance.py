"""Importance resampling of documents towards the word use of a target corpus.

Texts are taken as UTF-8 bytes. Capitals A-Z are lowered, every run of ASCII
characters that are neither letters nor digits becomes one space, and for each
length n an overlapped scan with boundary lookarounds gives the spans of all
runs of n words. The CRC-32 of a span, modulo the number of buckets, is its
feature.

One scan writes the buckets of every document; the counts of all documents and
of the target are sums over that table, and a weight is a sum of gains looked
up per bucket. A keyed Gumbel draw without replacement is the best scores.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import pick
from newsloom.sources.writers import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONGEST = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Texts are scanned together up to this many bytes; a longer text is a run of its own.
RUN = 1 << 20
# Spans of one run of texts must not cross from text to text.
BETWEEN = b"\n"


@cache
def _folding() -> bytes:
    """Capitals to small letters, other ASCII that is no letter or digit to space, the rest as it is."""
    table = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        table[b] = ord(c.lower()) if c.isalnum() else 0x20
    return bytes(table)


@cache
def _scanner(n: int) -> regex.Pattern:
    word = rb"[^ \n]+"
    return regex.compile(rb"(?<![^ \n])" + word + (rb" " + word) * (n - 1) + rb"(?![^ \n])")


def folded(text: bytes) -> bytes:
    """Words of a text, one space between them."""
    return regex.sub(rb" +", b" ", text.translate(_folding())).strip(b" ")


def run_buckets(texts: list[bytes], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of the texts in order of texts, features of each text, words of each text."""
    clean = [folded(t) for t in texts]
    together = BETWEEN.join(clean)
    ends = np.cumsum([len(t) + 1 for t in clean])
    found, owners = [], []
    for n in range(1, longest + 1):
        places, codes = [], []
        for m in _scanner(n).finditer(together, overlapped=True):
            places.append(m.start())
            codes.append(crc32(m.group()))
        found.append(np.array(codes, np.int64) % buckets)
        owners.append(np.searchsorted(ends, places, side="right"))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], np.bincount(owner, minlength=len(texts)), np.bincount(owners[0], minlength=len(texts))


def _scan(longest: int, buckets: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("buckets", pa.list_(pa.int32()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sizes = pc.fill_null(pc.binary_length(rows.column(1)), 0).to_numpy(zero_copy_only=False)
            run = (np.cumsum(sizes) - sizes) // RUN
            starts = np.flatnonzero(np.append(True, run[1:] != run[:-1])) if len(run) else run
            for a, b in zip(starts, np.append(starts[1:], len(run)), strict=True):
                texts = [t or b"" for t in rows.column(1).slice(a, b - a).cast(pa.binary()).to_pylist()]
                codes, counts, words = run_buckets(texts, longest, buckets)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(codes, pa.int32()))
                yield pa.RecordBatch.from_arrays([rows.column(0).slice(a, b - a), pa.array(words, pa.int64()), lists], schema=schema)

    return scan


def features(texts: DataFrame, id_col: str, text_col: str, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, buckets``: one bucket for every run of 1 to ``longest`` words, repeats included."""
    if longest < 1 or buckets < 1:
        raise ValueError("features have one word at least, and there is one bucket at least")
    rows = pick(texts, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_scan(longest, buckets), "doc_id long, n_words long, buckets array<int>")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows in each bucket. A task sends one row per bucket it met, so ``buckets`` bounds what is gathered."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for rows in batches:
            total += np.bincount(pc.list_flatten(rows.column(0)).to_numpy(zero_copy_only=False), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met])], schema=schema)

    counts = np.zeros(buckets, np.int64)
    for bucket, n in found.select("buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, target to source, for each bucket."""
    s, t, all_s, all_t, buckets = source, target, int(source.sum()), int(target.sum()), len(source)
    return np.array(
        [math.floor(1000 * math.log((int(t[b]) + 1) * (all_s + buckets) / ((int(s[b]) + 1) * (all_t + buckets)))) for b in range(buckets)], np.int64
    )


def weight_column(codes: Column, gains: np.ndarray) -> Column:
    """Sum of the gains of a row's buckets; zero without any."""

    @F.arrow_udf("long")
    def weigh(lists: pa.Array) -> pa.Array:
        sums = np.append(0, np.cumsum(gains[pc.list_flatten(lists).to_numpy(zero_copy_only=False)]))
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        return pa.array(sums[ends] - sums[np.append(0, ends[:-1])] if len(ends) else ends, pa.int64())

    return weigh(codes)


def gumbel_column(identifier: Column, seed: int) -> Column:
    """Thousandths of a Gumbel number that depends on the seed and the identifier (null as the empty text) alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _ranked(scored: DataFrame, drawn: int) -> DataFrame:
    """The ``drawn`` best rows with their place: sorted ranges, and the rows in the ranges before."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = stage(
        scored.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "weight", "score", "n_features", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")),
        "ranges",
    )
    sizes = best.groupBy("part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per range
    placed = best.join(F.broadcast(sizes.select("part", "first", before.alias("before"))), "part")  # bounded by the ranges
    rank = F.col("before") + F.col("place") - F.col("first") + 1
    return placed.select("doc_id", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_id: str = "item_id",
    target_text: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, n_features, weight, score, rank``.

    Null and empty texts have no features, weight zero, and are never drawn
    unless ``least_words`` is zero. ``percent`` of the documents with at least
    ``least_words`` words are drawn, rounded down; ties go to the smaller
    identifier, null identifiers last, equal ones in any order. Rows that
    repeat an identifier count one by one. An empty target gives smoothed
    shares alone; an empty table gives an empty result. Other columns are ignored.
    """
    found = stage(features(docs, id_col, text_col, longest, buckets), "features")
    gains = gains_of(bucket_counts(found, buckets), bucket_counts(features(target, target_id, target_text, longest, buckets), buckets))
    long_enough = F.col("n_words") >= least_words
    drawn = found.where(long_enough).count() * percent // 100
    weighed = found.select("doc_id", "n_words", F.size("buckets").cast("long").alias("n_features"), weight_column(F.col("buckets"), gains).alias("weight"))
    scored = stage(weighed.withColumn("score", F.col("weight") + gumbel_column(F.col("doc_id"), seed)), "scored")
    rest = scored.where(~long_enough).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return _ranked(scored.where(long_enough), drawn).unionByName(rest)


def drawn_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, in their own columns; rows that repeat a drawn identifier all stay."""
    chosen = resample(docs, target, id_col, **options).where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("_drawn")).distinct()
    key = "`" + id_col.replace("`", "``") + "`"
    return docs.join(chosen, F.col(key).cast("long") == F.col("_drawn"), "left_semi")
