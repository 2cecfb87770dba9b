"""Benchmark decontamination with a broadcast set of test n-grams.

The windows of all benchmark items become word-number sequences and their
hashes, a set that every task holds. A document is turned into word numbers
(zero for a word no item uses); only stretches of known words are hashed, a
hash that is found is verified word by word, and the words under verified
windows are the hits. Documents, or only the hit spans, can then be removed.

The set is measured before it is sent: a benchmark above ``SLICE_BYTES`` of text
is dealt into slices of that size, each with a broadcast of its own, and the
hits of all slices are merged in the row. No document is shuffled.
"""

from __future__ import annotations

import math
import re
import sys
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import fresh, pick, quoted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10
SLICE_BYTES = 16 << 20
# Separators of words: ASCII but for digits and letters. Upper case is lowered by the same table.
FOLD = bytes((c + 32) if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SCAN = "struct<n_words: long, ranges: array<struct<first: long, last: long>>, items: array<string>>"


# Plain values only, so that workers without this package can read a broadcast:
# word numbers, and by window length the hashes in order, the words behind them,
# and the items that hold each window.
Windows = tuple[np.ndarray, np.ndarray, list[list[str]]]
Grams = tuple[dict[bytes, int], dict[int, Windows]]


def words_of(data: bytes) -> list[bytes]:
    return data.translate(FOLD).split()


def _hash(rows: np.ndarray) -> np.ndarray:
    found = np.zeros(len(rows), np.uint64)
    for j in range(rows.shape[1]):
        found = found * MULTIPLIER + rows[:, j].astype(np.uint64)
        found ^= found >> np.uint64(29)
    return found


def build_grams(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Grams:
    """Windows of (identifier, text) items; an item of fewer words is one window, one without words none."""
    numbers: dict[bytes, int] = {}
    holders: dict[tuple[int, ...], set[str | None]] = defaultdict(set)
    for item, text in items:
        row = [numbers.setdefault(w, len(numbers) + 1) for w in words_of((text or "").encode())]
        length = min(window, len(row))
        for i in range(len(row) - length + 1 if row else 0):
            holders[tuple(row[i : i + length])].add(item)
    by_length = {}
    for length in sorted({len(k) for k in holders}):
        keys = [k for k in holders if len(k) == length]
        rows = np.array(keys, np.int64)
        hashes = _hash(rows)
        order = np.argsort(hashes, kind="stable")
        by_length[length] = (hashes[order], rows[order], [sorted(x for x in holders[keys[i]] if x is not None) for i in order])
    return numbers, by_length


def _verified(row: np.ndarray, known: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``row`` where a window stands, and which one. ``known``: running count of known words."""
    window_hashes, window_words, _ = windows
    length = window_words.shape[1]
    if len(row) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(known[length:] - known[:-length] == length)
    seen = row[at[:, None] + np.arange(length)]
    hashes = _hash(seen)
    low = np.searchsorted(window_hashes, hashes)
    places, which = [], []
    # more than one window may share a hash: look at each until the hash ends
    live = np.flatnonzero(low < len(window_hashes))
    while len(live):
        live = live[window_hashes[low[live]] == hashes[live]]
        same = (window_words[low[live]] == seen[live]).all(axis=1)
        places.append(at[live[same]])
        which.append(low[live[same]])
        live = live[~same]
        low[live] += 1
        live = live[low[live] < len(window_hashes)]
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(which)


def scan_texts(texts: list[bytes | None], grams: Grams) -> list[dict]:
    """Per text: number of words, hit ranges of word positions (last one excluded), and items, each once."""
    (numbers, by_length), counts, flat = grams, [], []
    for text in texts:
        words = words_of(text or b"")
        counts.append(len(words))
        flat.extend([numbers.get(w, 0) for w in words])
        flat.append(0)  # keeps windows from reaching into the next text
    row = np.array(flat, np.int64)
    known = np.concatenate([[0], np.cumsum(row > 0)])
    starts = np.concatenate([[0], np.cumsum(np.array(counts, np.int64) + 1)])[:-1]
    cover = np.zeros(len(row) + 1, np.int64)
    items: dict[int, set[str]] = defaultdict(set)
    for length, windows in by_length.items():
        places, which = _verified(row, known, windows)
        np.add.at(cover, places, 1)
        np.add.at(cover, places + length, -1)
        owners = np.searchsorted(starts, places, side="right") - 1
        for owner, w in set(zip(owners.tolist(), which.tolist(), strict=True)):
            items[owner].update(windows[2][w])
    hit = np.concatenate([[0], (np.cumsum(cover[:-1]) > 0).astype(np.int8), [0]])
    edges = np.diff(hit)
    firsts, lasts = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    ranges: dict[int, list[dict]] = defaultdict(list)
    for owner, a, b in zip((np.searchsorted(starts, firsts, side="right") - 1).tolist(), firsts.tolist(), lasts.tolist(), strict=True):
        base = int(starts[owner])
        ranges[owner].append({"first": a - base, "last": b - base})
    return [{"n_words": n, "ranges": ranges.get(i, []), "items": sorted(items.get(i, ()))} for i, n in enumerate(counts)]


SCAN_TYPE = pa.struct([
    ("n_words", pa.int64()),
    ("ranges", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
    ("items", pa.list_(pa.string())),
])


def _scanner(spark, grams: Grams):
    sent = spark.sparkContext.broadcast(grams)

    @F.arrow_udf(SCAN)
    def scan(text: pa.Array) -> pa.Array:
        return pa.array(scan_texts(text.cast(pa.binary()).to_pylist(), sent.value), SCAN_TYPE)

    return scan


def slices_of(benchmark: DataFrame, slice_bytes: int = SLICE_BYTES) -> list[list[tuple[str | None, str | None]]]:
    """The items in groups that are small enough to broadcast; one group unless the benchmark is large."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / slice_bytes))
    if parts == 1:
        return [[tuple(r) for r in items.collect()]]
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    return [[tuple(r) for r in dealt.where(F.col("part") == i).drop("part").collect()] for i in range(parts)]


def _n_hit(ranges: Column) -> Column:
    """Words under sorted ranges that may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        ranges,
        start,
        lambda done, r: F.struct(
            F.greatest(done["end"], r["last"]).alias("end"),
            (done["total"] + F.greatest(F.lit(0).cast("long"), r["last"] - F.greatest(done["end"], r["first"]))).alias("total"),
        ),
        lambda done: done["total"],
    )


def _cut(text: str | None, ranges: list[dict] | None) -> str | None:
    if not text or not ranges:
        return text
    spots = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for r in ranges:
        kept.append(text[at : max(at, spots[r["first"]][0])])
        at = max(at, spots[r["last"] - 1][1])
    return "".join([*kept, text[at:]])


def _without(text: Column, ranges: Column) -> Column:
    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array(map(_cut, texts.to_pylist(), spans.to_pylist()), pa.string())

    return cut(text, ranges)


def with_hits(
    docs: DataFrame, benchmark: DataFrame, into: str, text_col: str = "text", window: int = WINDOW, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """All columns of ``docs`` and ``into``: struct of n_words, n_hit, items and ranges.

    ``items`` are the identifiers with occurring windows as sorted strings, each
    once; ``ranges`` the hit word positions in order. Null texts have no words;
    items without an identifier hit words but are not named; items without
    words hit nothing. An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    found = [_scanner(spark, build_grams(part, window))(F.col(quoted(text_col))) for part in slices_of(benchmark, slice_bytes)]
    raw = fresh(docs, into)
    parts = docs.withColumn(raw, F.array(*found))
    ranges = F.array_sort(F.flatten(F.transform(raw, lambda s: s["ranges"])))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform(raw, lambda s: s["items"]))))
    return parts.withColumn(
        into,
        F.struct(
            F.get(raw, F.lit(0))["n_words"].alias("n_words"), _n_hit(ranges).alias("n_hit"), items.alias("items"), ranges.alias("ranges")
        ),
    ).drop(raw)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items, ranges``; see ``with_hits``."""
    return with_hits(pick(docs, doc_id=id_col, text=text_col), benchmark, "hits", **options).select("doc_id", "hits.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without documents that hold a window, or (``remove="spans"``) without the words of the windows.

    A cut reaches from the first letter of the first hit word to the last of
    the last one and leaves the rest of the text as it is. Other columns stay.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is documents or spans")
    hits = fresh(docs)
    found = with_hits(docs, benchmark, hits, text_col, **options)
    if remove == "documents":
        return found.where(F.col(hits)["n_hit"] == 0).select(*[quoted(c) for c in docs.columns])
    text = F.when(F.col(hits)["n_hit"] > 0, _without(F.col(quoted(text_col)), F.col(hits)["ranges"])).otherwise(F.col(quoted(text_col)))
    return found.select(*[text.alias(c) if c == text_col else F.col(quoted(c)) for c in docs.columns])
