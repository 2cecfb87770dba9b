"""Token-id files: Parquet with list columns, in the order of the documents.

``data/`` holds one row per document: ``doc_id, shard, start_in_shard, n_tokens,
ids``. Row groups are small and pages carry an index, so a reader that asks for
some documents, or for the columns without ``ids``, reads only those pages.
Token ids are dictionary coded, the growing columns delta coded. ``index/``
holds one row per shard with the ids before it, ``base``; the place of a
document in the whole stream is ``base + start_in_shard``.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.common import pick
from newsloom.llm.encoder import worker_encoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKENIZER = "byte_bpe_50k.json"
END = 0
# Bytes of a row group in memory, and rows of a page: what a selective read must touch at least.
ROW_GROUP = 32 << 20
PAGE_ROWS = 2_000
# Bytes of text that are encoded at once.
CHUNK = 1_000_000
CODED = pa.schema([
    ("doc_id", pa.int64()), ("shard", pa.int32()), ("start_in_shard", pa.int64()), ("n_tokens", pa.int64()),
    ("ids", pa.list_(pa.int32())),
])


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about CHUNK bytes; a longer text is a run of its own."""
    start, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if size and size + n > CHUNK:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def _coder(path: str, end: int | None):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard, start = worker_encoder(path, end), TaskContext.get().partitionId(), 0
        for rows in batches:
            for a, b in _chunks(rows.column(1)):
                ids, sizes = encoder.encode(rows.column(1).slice(a, b - a))
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).slice(a, b - a), pa.array(np.full(b - a, shard, np.int32)), pa.array(start + ends - sizes),
                        pa.array(sizes), lists,
                    ],
                    schema=CODED,
                )
                start += int(sizes.sum())

    return code


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end: int | None = END, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode whole texts, append ``end`` to each, and write them under ``path`` in ascending order of identifier.

    Null and empty texts have the end id only. Null identifiers come first;
    rows that repeat one are ordered by text. An empty table writes an index
    without rows. Files are committed by Spark: all of a write or nothing.
    """
    coded = (
        pick(docs, doc_id=id_col, text=text_col)
        .select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_coder(tokenizer, end), "doc_id long, shard int, start_in_shard long, n_tokens long, ids array<int>")
    )
    (
        coded.write.mode("overwrite")
        .option("parquet.block.size", ROW_GROUP)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        # growing values have no repeats: delta coding, the choice of this writer version without a dictionary
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#start_in_shard", "false")
        .option("compression", "zstd")
        .parquet(f"{path}/data")
    )
    data = docs.sparkSession.read.parquet(f"{path}/data")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = data.groupBy("shard").agg(
        F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )
    shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``; select the columns that are needed, others are not read."""
    index = spark.read.parquet(f"{path}/index").select("shard", "base")
    # one row per shard, so the broadcast is bounded by the number of write tasks
    return spark.read.parquet(f"{path}/data").join(F.broadcast(index), "shard").select(
        "doc_id", (F.col("base") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids"
    )


def ids_crc32(ids: Column) -> Column:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def crc(lists: pa.Array) -> pa.Array:
        values, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
        return pa.array([zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.int64())

    return crc(ids)
