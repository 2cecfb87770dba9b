"""Codes for vectors: product quantisation in whole numbers.

Components become whole numbers and a vector is cut into equal parts; each part
position has a codebook of at most 256 entries. A batch keeps, for every
dimension, a dictionary of its distinct values: squared differences of each
distinct value to all entries are tabulated once, and the distances of all parts
are gathers from those tables by dictionary code, added over the dimensions.

A round sends one row per task and entry with the sums of its parts; codebooks
are bounded by their size and travel with the tasks.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import pick
from newsloom.operators.lookup import lookup_join
from newsloom.sources.writers import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Rows whose distances are worked out together: their sums stay in the processor's cache.
BLOCK = 512
# Largest whole number of a component: sums of squared differences stay within 64 bits for parts of up to 8192 dimensions.
LARGEST = 1 << 24


def part_distances(values: np.ndarray, entries: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Squared distances of the rows of ``values`` to all entries, block by block, with the first row of each."""
    dims = values.shape[1]
    small = len(values) and int(np.abs(values).max()) + int(np.abs(entries).max()) < int((2**31 / dims) ** 0.5)
    kind = np.int32 if small else np.int64
    tables, codes = [], []
    for d in range(dims):
        distinct, code = np.unique(values[:, d], return_inverse=True)
        tables.append((distinct[:, None].astype(kind) - entries[None, :, d].astype(kind)) ** 2)
        codes.append(code)
    for at in range(0, len(values), BLOCK):
        sums = np.zeros((min(BLOCK, len(values) - at), len(entries)), kind)
        for table, code in zip(tables, codes, strict=True):
            sums += table[code[at : at + BLOCK]]
        yield at, sums


def nearest(values: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry (the lowest of equals) and the squared distance to it."""
    found, far = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
    for at, sums in part_distances(values, entries):
        best = sums.argmin(axis=1)
        found[at : at + len(best)] = best
        far[at : at + len(best)] = sums[np.arange(len(best)), best]
    return found, far


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    return pc.list_flatten(lists).to_numpy(zero_copy_only=False).reshape(-1, dims)


def _round(codebooks: np.ndarray):
    parts, entries, width = codebooks.shape
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for rows in batches:
            values = _matrix(rows.column(0), parts * width)
            for p in range(parts):
                part = values[:, p * width : (p + 1) * width]
                found, _ = nearest(part, codebooks[p])
                order = np.argsort(found, kind="stable")
                met, starts = np.unique(found[order], return_index=True)
                counts[p] += np.bincount(found, minlength=entries)
                if len(met):
                    sums[p, met] += np.add.reduceat(part[order].astype(np.int64), starts, axis=0)
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], schema=schema
        )

    return assign


def _coder(codebooks: np.ndarray):
    parts, _, width = codebooks.shape
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            values = _matrix(rows.column(2), parts * width)
            found = [nearest(values[:, p * width : (p + 1) * width], codebooks[p]) for p in range(parts)]
            digits = np.stack([f for f, _ in found], axis=1).astype(np.uint8) if len(values) else np.zeros((0, parts), np.uint8)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array([d.tobytes().hex() for d in digits], pa.string()), pa.array(sum(e for _, e in found), pa.int64())],
                schema=schema,
            )

    return code


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v``: vectors of finite components only, each floor(scale * x); the label as text.

    A component beyond ``LARGEST`` after scaling has no exact squared distance and is an error.
    """
    rows = pick(vectors, vec_id=id_col, label=label_col, v=vector_col)
    finite = F.forall("v", lambda x: F.coalesce(x.cast("double").between(-sys.float_info.max, sys.float_info.max), F.lit(False)))
    scaled = F.transform("v", lambda x: F.floor(F.lit(scale).cast("double") * x.cast("double")))
    sound = F.forall("v", lambda x: F.abs(F.lit(scale).cast("double") * x.cast("double")) <= LARGEST)
    checked = F.when(sound, scaled).otherwise(F.raise_error(F.lit("a vector component is too large for exact distances")))
    return rows.where((F.size("v") > 0) & finite).select(
        F.col("vec_id").cast("long"), F.col("label").cast("string"), checked.cast("array<int>").alias("v")
    )


def first_codebooks(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """Parts of the vectors with the smallest identifiers, as (part, entry, position)."""
    first = whole.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()  # bounded by the entries
    sizes = whole.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    if sizes["least"] != sizes["most"] or sizes["most"] % parts:
        raise ValueError(f"vectors have {sizes['least']} to {sizes['most']} components; one length divisible by {parts} is needed")
    values = np.array([r["v"] for r in first], np.int64)
    return values.reshape(len(values), parts, -1).transpose(1, 0, 2).copy()


def fit_codebooks(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks after ``rounds`` of assigning every part and replacing entries by floored means; unused entries stay."""
    codebooks = first_codebooks(whole, parts, entries)
    width = codebooks.shape[2]
    for _ in range(rounds):
        sent = whole.select("v").mapInArrow(_round(codebooks), "part int, entry int, n long, sums array<long>")
        sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
        new = codebooks.copy()
        for row in sent.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():  # one row per entry
            new[row["part"], row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
        codebooks = new
    return codebooks


def codebooks_text(codebooks: np.ndarray) -> str:
    """Decimal components by part, entry and position, joined by commas."""
    return ",".join(map(str, codebooks.ravel().tolist()))


def encode(whole: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of whole vectors: two hexadecimal digits per part."""
    if codebooks.shape[1] > 256:
        raise ValueError("a code of two hexadecimal digits has room for 256 entries")
    return whole.select("vec_id", "label", "v").mapInArrow(_coder(codebooks), "vec_id long, label string, code string, error long")


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """One row per kept vector: ``vec_id, code, error, label_error, codebooks_sha256``.

    Rows whose vector is null, has no components, or holds a null, a NaN or an
    infinity are left out; all others need one length. Null identifiers come last among the first
    entries, equal identifiers in the order of their vectors; repeated rows
    count one by one. Null labels form one group. Fewer vectors than entries
    give smaller codebooks; no vector gives no row. Other columns are ignored.
    """
    whole = stage(whole_vectors(vectors, id_col, vector_col, label_col), "whole-vectors")
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if whole.isEmpty():
        return whole.sparkSession.createDataFrame([], schema)
    codebooks = fit_codebooks(whole, parts, entries, rounds)
    # a null label and a label that is the word null differ by the mark before it
    key = F.when(F.col("label").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "label"))
    coded = stage(encode(whole, codebooks).withColumn("key", key), "codes")
    sums = coded.groupBy("key").agg(F.sum("error").alias("label_error"))
    joined = lookup_join(coded, stage(sums, "label-errors"), "key", spread_by=["vec_id"])
    digest = hashlib.sha256(codebooks_text(codebooks).encode()).hexdigest()
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
