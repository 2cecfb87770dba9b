"""DataFrames to files. Spark commits a write as a whole or not at all."""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.keywords import LEADERBOARD_SIZE, leaderboard
from newsloom.sources.staging import stage  # noqa: F401

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters after which an array is full; a file of one array is one row of one task when it is read.
ARRAY_CHARS = 4 << 20
# What may stand before the first element: white space, a byte order mark, or nothing.
LEADS = ("\n\t[ ", "[", "\ufeff[", " \r\n[\n")


def write_json(df: DataFrame, path: str, mode: str = "overwrite", order: Sequence[str] = ()) -> None:
    """One object per line, UTF-8, other scripts kept as they are.

    With ``order`` the rows follow it through the files, taken by name.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.write.mode(mode).option("encoding", "UTF-8").json(path)


def _full_arrays(batches: Iterator[pa.RecordBatch], array_chars: int) -> Iterator[pa.RecordBatch]:
    """The objects of a task, in their order, as texts of arrays."""

    def closed(held: list[str]) -> pa.RecordBatch:
        lead = LEADS[zlib.crc32(held[0].encode()) % len(LEADS)]
        return pa.RecordBatch.from_arrays([pa.array([f"{lead}{',\n\t'.join(held)} ]\r\n "])], ["value"])

    held: list[str] = []
    length = 0
    for rows in batches:
        for element in rows.column(0):
            held.append(element.as_py())
            length += len(held[-1])
            if length >= array_chars:
                yield closed(held)
                held, length = [], 0
    if held:
        yield closed(held)


def write_json_arrays(df: DataFrame, path: str, key: str, order: Sequence[str] = (), array_chars: int = ARRAY_CHARS) -> None:
    """Files of one array each, as many as the length of the rows asks for, whatever their keys are.

    Rows of one ``key`` lie in one file, or in files that follow each other by
    name, in the ``order`` given; rows without one are dealt out by content.
    White space or a byte order mark stands around an array, as in landed files.
    """
    objects = df.withColumn("_object", F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    dealt = objects.repartition(F.coalesce(F.col(key).cast("string"), F.md5("_object")))
    placed = dealt.sortWithinPartitions(*order, "_object").select("_object")
    arrays = placed.mapInArrow(lambda batches: _full_arrays(batches, array_chars), "value string")
    arrays.write.option("maxRecordsPerFile", 1).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_keyword_map(scores: DataFrame, path: str, n: int = LEADERBOARD_SIZE) -> None:
    """The leaderboard as one JSON object, best first; n rows meet in one task."""
    best = leaderboard(scores, n)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("key"), "word", "score")))
    entries = F.transform(ordered, lambda e: F.struct(e["word"].alias("key"), e["score"].alias("value")))
    best.agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.mode("overwrite").text(path)
