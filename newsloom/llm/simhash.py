"""SimHash near-duplicates with bit-sliced comparison.

A fingerprint takes the majority of the bits of all shingle hashes. Fingerprints
that differ in at most ``radius`` bits agree in at least ``blocks - radius`` of
``blocks`` bit ranges, so every choice of that many ranges gives a bucket key,
and all links lie inside buckets. Equal fingerprints are one row by then.

Inside a bucket fingerprints are stored as bit planes: word w of plane b holds
bit b of 64 fingerprints. A query flips the planes of its set bits, carry-save
adders count the ones of 64 distances at a time, and words whose 64 distances
all exceed the radius are left out after every eight planes. A bucket sends a
spanning forest of its links, never its pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import fresh, pick, quoted
from newsloom.llm.components import connected
from newsloom.sources.writers import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 4
RADIUS = 4
SEED = 42
# 15 keys of about 21 bits. More ranges give longer keys and more of them: raise
# it when the number of fingerprints is far above 2^21.
BLOCKS = 6
# Buckets above this size are dealt out in pairs of parts over several tasks.
BUCKET = 1 << 15
SMALL_RUN = 32
QUERIES_AT_ONCE = 64
LANES_AT_ONCE = 1 << 17
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of UTF-8 text; no words give zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts)
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t or b"", shingle) for t in texts.cast(pa.binary()).to_pylist()], pa.int64())

    return of(F.coalesce(text, F.lit("")))


def planes_of(prints: np.ndarray) -> np.ndarray:
    """Bit planes, 64 rows of one word for each 64 fingerprints; missing lanes are zero."""
    words = -(-len(prints) // 64)
    bits = np.zeros((words * 64, 64), np.uint8)
    bits[: len(prints)] = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8").astype(np.uint64)


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: sum and carry of three planes."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def _exceeds(counter: tuple[np.ndarray, ...], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose three-bit count, or ``over``, is above the radius."""
    above, equal = over, ~over
    for plane, weight in zip(counter, (4, 2, 1), strict=True):
        if radius & weight:
            equal = equal & plane
        else:
            above = above | (equal & plane)
            equal = equal & ~plane
    return above


def within(planes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """For each query the packed lanes at no more than ``radius`` (at most 7) bits from it."""
    n, words = len(queries), planes.shape[1]
    flips = np.where(np.unpackbits(queries.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T > 0, ALL, np.uint64(0))
    query, word = (x.ravel() for x in np.indices((n, words)))
    ones, twos, fours, over = (np.zeros(n * words, np.uint64) for _ in range(4))
    for at in range(0, 64, 8):
        x = [planes[b, word] ^ flips[b, query] for b in range(at, at + 8)]
        ones, two_a = _add(ones, x[0], x[1])
        ones, two_b = _add(ones, x[2], x[3])
        twos, four_a = _add(twos, two_a, two_b)
        ones, two_a = _add(ones, x[4], x[5])
        ones, two_b = _add(ones, x[6], x[7])
        twos, four_b = _add(twos, two_a, two_b)
        fours, eights = _add(fours, four_a, four_b)
        over = over | eights
        dead = _exceeds((fours, twos, ones), over, radius)
        alive = np.flatnonzero(dead != ALL)
        if len(alive) < len(query):
            query, word, ones, twos, fours, over, dead = (v[alive] for v in (query, word, ones, twos, fours, over, dead))
            if not len(alive):
                break
    found = np.zeros((n, words), np.uint64)
    found[query, word] = ~dead
    return found


def _unpacked(lanes: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(lanes.astype("<u8").view(np.uint8), bitorder="little")[:n])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable number of each of n nodes under links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def bucket_forest(prints: np.ndarray, radius: int) -> np.ndarray:
    """Smallest reachable place of each fingerprint of one bucket; every pair is compared, in blocks."""
    root = np.arange(len(prints))
    for at in range(0, len(prints), QUERIES_AT_ONCE):
        rest = prints[at:]  # pairs with earlier ones are done
        queries = rest[:QUERIES_AT_ONCE]
        for low in range(0, len(rest), LANES_AT_ONCE):
            lanes = rest[low : low + LANES_AT_ONCE]
            for i, hits in enumerate(within(planes_of(lanes), queries, radius)):
                near = at + low + _unpacked(hits, len(lanes))
                joined = np.unique(np.append(root[near], root[at + i]))
                if len(joined) > 1:
                    root[np.isin(root, joined)] = joined[0]
    return root


def link_runs(keys: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the runs of equal keys: fingerprints, and the one their tree hangs on."""
    starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
    sizes = np.diff(np.append(starts, len(keys)))
    run = np.repeat(np.arange(len(starts)), sizes)
    small = np.repeat((sizes > 1) & (sizes <= SMALL_RUN), sizes)
    left, right = [], []
    for step in range(1, SMALL_RUN):
        i = np.flatnonzero(small[:-step] & (run[:-step] == run[step:])) if step < len(run) else np.zeros(0, np.int64)
        if not len(i):
            break
        for at in range(0, len(i), LANES_AT_ONCE):
            part = i[at : at + LANES_AT_ONCE]
            near = part[_unpacked(within(planes_of(prints[part] ^ prints[part + step]), np.zeros(1, np.uint64), radius)[0], len(part))]
            left.append(near)
            right.append(near + step)
    root = np.arange(len(prints))
    if left:
        root = forest(len(prints), np.concatenate(left), np.concatenate(right))
    for r in np.flatnonzero(sizes > SMALL_RUN):
        a, b = starts[r], starts[r] + sizes[r]
        root[a:b] = a + bucket_forest(prints[a:b], radius)
    linked = np.flatnonzero(root != np.arange(len(root)))
    return prints[linked], prints[root[linked]]


def _linker(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; the last key of a batch waits for the next one."""
        keys, prints = np.zeros((0, 3), np.int64), np.zeros(0, np.uint64)
        waiting: list[pa.RecordBatch] = []

        def flush(last: bool) -> pa.RecordBatch | None:
            nonlocal keys, prints
            rows = pa.Table.from_batches(waiting)
            waiting.clear()
            columns = [rows.column(i).to_numpy() for i in range(4)]
            keys = np.concatenate([keys, np.stack(columns[:3], axis=1)])
            prints = np.concatenate([prints, columns[3].view(np.uint64)])
            cut = len(keys) if last else int(np.flatnonzero((keys != keys[-1]).any(axis=1)).max(initial=-1)) + 1
            a, b = link_runs(keys[:cut], prints[:cut], radius) if cut else (np.zeros(0, np.uint64),) * 2
            keys, prints = keys[cut:], prints[cut:]
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

        for rows in batches:
            if rows.num_rows:
                waiting.append(rows)
            if sum(r.num_rows for r in waiting) >= LANES_AT_ONCE:
                yield flush(False)
        if waiting:
            yield flush(True)
        elif len(keys):
            a, b = link_runs(keys, prints, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    return link


def bucket_masks(blocks: int, radius: int) -> list[int]:
    """Bit masks, one for each choice of the ranges that must agree, as signed numbers."""
    bounds = [round(64 * i / blocks) for i in range(blocks + 1)]
    ranges = [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:], strict=False)]
    masks = [sum(c) for c in combinations(ranges, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links_of(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints (distinct, column ``fp``) within the radius."""
    if not 0 <= radius <= 7 or blocks <= radius:
        raise ValueError("the radius is 0 to 7 and there are more blocks than that")
    masks = bucket_masks(blocks, radius)
    key = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)]))
    keyed = prints.select("fp", key.alias("k")).select("k.choice", "k.bits", "fp")
    large = stage(keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).where(F.col("n") > bucket), "large-buckets")
    if large.isEmpty():
        dealt = keyed.withColumn("part", F.lit(0).cast("long"))
    else:  # parts of a large bucket meet in pairs, each pair a run of its own
        parts = F.coalesce(F.ceil(F.col("n") * 2 / bucket), F.lit(1)).cast("long")
        own = F.pmod(F.xxhash64("fp"), F.col("parts"))
        pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda j: F.least(F.col("own"), j) * F.col("parts") + F.greatest(F.col("own"), j))
        dealt = (
            keyed.join(large, ["choice", "bits"], "left").withColumn("parts", parts).withColumn("own", own)
            .select("choice", "bits", "fp", F.explode(pairs).alias("part"))
        )
    return (
        dealt.select("choice", "bits", "part", "fp")
        .repartition("choice", "bits", "part")
        .sortWithinPartitions("choice", "bits", "part", "fp")
        .mapInArrow(_linker(radius), "a long, b long")
    )


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS, bucket: int = BUCKET
) -> DataFrame:
    """Group of every row: ``doc_id, fp, component_id``, fp as a signed number.

    Null and empty texts have fingerprint zero and link like any other. Rows that
    repeat an identifier count as often as they are there. Null identifiers are
    never a component's name unless it has no other. Other columns are ignored.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), fingerprint_column(F.col("text"), shingle).alias("fp"))
    rows = stage(rows, "fingerprints")
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    trees = stage(connected(links_of(prints, radius, blocks, bucket)).select(F.col("node").alias("fp"), "root"), "trees")
    names = trees.join(prints, "fp").groupBy("root").agg(F.min("first_id").alias("name"))
    named = prints.join(trees.join(names, "root"), "fp", "left").select("fp", F.coalesce("name", "first_id").alias("component_id"))
    # a fingerprint that fills much of the corpus is one row here, so Spark may split its rows on the other side
    return rows.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest identifier.

    Rows that repeat that identifier are one document and one of them stays.
    Rows without an identifier cannot be named and all stay.
    """
    kept, at = fresh(docs), F.col(quoted(id_col))
    named = near_groups(docs.where(at.isNotNull()), id_col, text_col, **options).where("doc_id = component_id")
    found = docs.join(named.select(F.col("doc_id").alias(kept)).distinct(), at.cast("long") == F.col(kept), "left_semi")
    return found.dropDuplicates([id_col]).unionByName(docs.where(at.isNull()))
