"""Exact de-duplication by sorting the content.

Sampled splitters deal the normalised texts out by range, each range is sorted
(on disk where it must be), equal texts then stand next to each other, and a
comparison of whole neighbouring keys finds the groups. The smallest
identifier of a group stays.

Before anything is shuffled, the copies inside one Arrow batch are folded into
one row, so that a text which fills a third of the corpus sends one row per
batch into its range. The folded rows are staged: the sample for the
splitters, the sort and the list of members read that table, not the corpus.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import WHITE, fresh, pick, quoted
from newsloom.sources.writers import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters of a text that take part in a splitter. Texts with one head are
# told apart by a hash there, and by the whole text in the comparison.
HEAD = 32
FOLDED = pa.schema([("content", pa.string()), ("first_id", pa.int64()), ("ids", pa.list_(pa.int64()))])


def fold_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct text of a batch, with the identifiers that carry it, in order."""
    for rows in batches:
        if not rows.num_rows:
            continue
        ids, content = rows.column(0), rows.column(1).dictionary_encode()
        order = pc.sort_indices(
            pa.table({"code": content.indices, "id": ids}),
            sort_keys=[("code", "ascending"), ("id", "ascending")],
            null_placement="at_end",
        )
        codes = content.indices.take(order).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.diff(codes, prepend=-1))
        members = pa.ListArray.from_arrays(pa.array(np.append(starts, len(codes)), pa.int32()), ids.take(order))
        yield pa.RecordBatch.from_arrays(
            [content.dictionary.take(pa.array(codes[starts])), ids.take(order.take(pa.array(starts))), members],
            schema=FOLDED,
        )


def normalised(text: str = "text"):
    """Every run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group of every row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null texts are empty texts and equal each other. Identifiers are integers;
    a null identifier stays only if its group has no other. Rows that repeat
    an identifier inside a group count each in ``group_size``; the one kept is
    decided by the identifier, so all rows with ``keep_id`` are kept. An empty
    table gives an empty result. Other columns are ignored, whatever their names.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), normalised().alias("content"))
    folded = stage(
        rows.mapInArrow(fold_batches, "content string, first_id long, ids array<long>")
        .select(
            F.monotonically_increasing_id().alias("entry"),
            F.left("content", F.lit(HEAD)).alias("head"),
            F.xxhash64("content").alias("mark"),
            "content",
            "first_id",
            "ids",
        ),
        "folded-texts",
    )
    # The ranges already keep equal texts together, so the window needs no second
    # exchange. Splitters are heads of texts: whole ones would not fit the driver.
    group = Window.partitionBy("head", "mark", "content")
    found = (
        folded.select("head", "mark", "content", "first_id", F.size("ids").alias("n"), "entry")
        .repartitionByRange("head", "mark")
        .select(
            "entry",
            F.min("first_id").over(group).alias("keep_id"),
            F.sum("n").over(group).alias("group_size"),
            F.sha2("content", 256).alias("text_sha256"),
        )
    )
    # an entry stands for the rows of one batch at most, so this join has no hot key
    return (
        folded.select("entry", "ids")
        .join(found, "entry")
        .select(F.explode("ids").alias("doc_id"), "keep_id", "group_size", "text_sha256")
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    name = fresh(docs)
    kept = exact_groups(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(kept, F.col(quoted(id_col)).cast("long").eqNullSafe(F.col(name)), "left_semi")
