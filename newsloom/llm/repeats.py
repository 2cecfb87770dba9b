"""Removal of byte strings that an earlier document already holds.

A window is a string of ``depth`` bytes. Its anchor is the smallest hash of its
grams, so equal windows have equal anchors, and a run of windows with one anchor
is a piece of text. Three steps, each one shuffle:

1. Anchors of all windows are dealt out by anchor; those of one document only
   cannot hold a repeat and go no further. Only hashes travel.
2. Pieces of the other anchors are dealt out by anchor. A task folds equal
   pieces of its shard before it sends them.
3. Where the pieces of an anchor meet, every shard has its Burrows-Wheeler
   transform, and the transforms are merged: starting from one block of all rows,
   each turn prepends the few symbols before a row and so refines the interleave;
   after k symbols a block holds the rows that share a prefix of k bytes. Rows move
   by the LF mapping of their own shard; suffixes of different shards are never
   compared. Blocks of one document are finished early, as they lie in order
   already. Blocks that are left at ``depth`` are the intervals of common prefix
   ``depth``, hence the repeats.

A bucket of pieces that is too large for one task is cut again at anchors of
longer grams, at last of whole windows, of which a shard sends each one once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import pick
from newsloom.sources.writers import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEPTH = 50
GRAM = 24
# Bytes of text that are hashed together.
STRIP = 1 << 16
# Bytes of text of a shard whose anchors are sent, and bytes of pieces of a shard.
SHARD = 1 << 23
SHARD_PIECES = 3 << 23
# Longest run of windows of a piece.
RUN = 1 << 12
# Bytes of pieces of a bucket as planned, the most that one task takes at once, and the most that is merged at once.
BUCKET = 2 << 20
LARGEST = 16 << 20
MERGED = 96 << 10
# Bytes of pieces of one anchor that are still merged, and symbols of one transform.
ANCHOR = 4 << 20
TRANSFORM = 1 << 14
# Symbols that decide the order of the suffixes in a transform: the merge puts what is alike beyond them in its own order.
CONTEXT = 48

ONE = np.uint64(1)
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the gram that begins at each place."""
    size, power, whole = 1, MIX[0], text.astype(np.uint64) + ONE
    done, found = 0, None
    while True:
        if gram & size:
            found = whole if found is None else found[: len(whole) - done] * power + whole[done:]
            done += size
            if done == gram:
                return mixed(found)
        whole = whole[:-size] * power + whole[size:]
        size, power = 2 * size, np.multiply(power, power)


def anchors(text: np.ndarray, depth: int, gram: int) -> np.ndarray:
    """Smallest hash of the grams of the window that begins at each place."""
    least, size, wide = gram_hashes(text, gram), 1, depth - gram + 1
    while 2 * size <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < wide:
        least = np.minimum(least[: size - wide], least[wide - size :])
    return least


def runs(text: np.ndarray, ends: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, number of windows and anchor of the pieces of segments that end at ``ends``."""
    none = np.zeros(0, np.int64)
    if len(text) < depth:
        return none, none, none.astype(np.uint64)
    least = anchors(text, depth, gram)
    places = np.arange(len(least))
    inside = np.repeat(ends, np.diff(ends, prepend=0))[: len(least)] >= places + depth
    bound = np.append(True, least[1:] != least[:-1])
    bound[::RUN] = True
    bound |= ~inside  # places whose window would reach into the next segment part the runs of two segments
    bound[1:] |= ~inside[:-1]
    bounds = np.flatnonzero(bound)
    sizes = np.diff(np.append(bounds, len(least)))
    whole = inside[bounds]
    bounds = bounds[whole]
    return bounds, sizes[whole], mixed(least[bounds] ^ MIX[0])


def strips(texts: list[bytes], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined into strips: bytes, end of each segment, its text, and the place in the text where it begins.

    A long text lies in several segments that overlap, so that each of its windows is in exactly one.
    """
    waiting: list[tuple[int, int, bytes]] = []
    size = 0

    def joined():
        ends = np.cumsum([len(s) for _, _, s in waiting])
        return np.frombuffer(b"".join(s for _, _, s in waiting), np.uint8), ends, np.array([i for i, _, _ in waiting]), np.array([a for _, a, _ in waiting])

    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - depth + 1, 0), STRIP):
            segment = text[at : at + STRIP + depth - 1]
            waiting.append((i, at, segment))
            size += len(segment)
            if size >= STRIP:
                yield joined()
                waiting, size = [], 0
    if waiting:
        yield joined()


def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length, compressed; the identifiers as differences, which are small in the order of a scan."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def unpacked(data: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    """The columns again, and what follows them as bytes."""
    raw, at, columns = zstandard.ZstdDecompressor().decompress(data), 0, []
    for kind in kinds:
        columns.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return [*columns, np.frombuffer(raw, np.uint8, len(raw) - at, at)]


def steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=0)


def groups(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    change = np.zeros(len(keys[0]) - 1, bool)
    for k in keys:
        change |= k[1:] != k[:-1]
    return np.flatnonzero(np.append(True, change))


def spread(flags: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """A value of each group, for each of its members."""
    return np.repeat(flags, np.diff(np.append(starts, n)))


def in_order(key: np.ndarray) -> np.ndarray:
    """Stable order of numbers that are not negative: key and place in one number where both fit."""
    bits = len(key).bit_length()
    if len(key) and int(key.max()).bit_length() + bits > 63:
        return np.argsort(key, kind="stable")
    both = key.astype(np.int64) << bits | np.arange(len(key))
    both.sort()
    return both & ((1 << bits) - 1)


def of_several(starts: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Groups, given by their starts, that have two documents at least."""
    if not len(starts):
        return np.zeros(0, bool)
    return np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)


def home(anchor: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of an anchor, and the number that tells it from the others of its bucket."""
    return ((anchor >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), (anchor & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def code_of(anchor: np.ndarray, buckets: int) -> np.ndarray:
    bucket, low = home(anchor, buckets)
    return bucket << 32 | low


# A row between two steps: the bucket it is dealt to (below zero: no work is left, spread by that number), how many entries, and these.
DEALT = pa.schema([("bucket", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
DEALT_DDL = "bucket long, n long, data binary"


def dealt(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, DEALT, strict=True)], schema=DEALT)


def texts_in(rows: pa.RecordBatch, i: int) -> list[bytes]:
    return [t or b"" for t in rows.column(i).cast(pa.binary()).to_pylist()]


# ---- step 1: anchors of more than one document


def _anchor_rows(depth: int, gram: int, buckets: int):
    def send(waiting: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, mark, code = (np.concatenate(c) for c in zip(*waiting, strict=True))
        order = in_order(code)
        doc, mark, code = doc[order], mark[order], code[order]
        first = groups(doc, mark, code)  # a text repeats an anchor: its entries are neighbours, as texts come one by one
        doc, mark, code = doc[first], mark[first], code[first]
        starts = groups(code)
        here = spread(of_several(starts, doc), starts, len(code))
        # of an anchor that documents of this shard share, one entry tells the others of it
        witness = np.zeros(len(code), bool)
        witness[starts] = True
        rows = []
        if here.any():
            rows.append((-1 - int(code[0] & 0xFFFF), int(here.sum()), packed(steps(doc[here]), mark[here], code[here])))
        sent = ~here | witness
        doc, mark, code, known = doc[sent], mark[sent], code[sent], here[sent]
        bucket = code >> 32
        starts = groups(bucket)
        for a, b in zip(starts, np.append(starts[1:], len(bucket)), strict=True):
            low = steps(code[a:b] & 0xFFFFFFFF).astype(np.uint32)
            rows.append((int(bucket[a]), int(b - a), packed(steps(doc[a:b]), mark[a:b], low, known[a:b])))
        return dealt(rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for rows in batches:
            doc_ids, marks = rows.column(0).to_numpy(zero_copy_only=False), rows.column(1).to_numpy(zero_copy_only=False)
            for text, ends, owner, _ in strips(texts_in(rows, 2), depth):
                start, _, anchor = runs(text, ends, depth, gram)
                who = owner[np.searchsorted(ends, start, side="right")]
                waiting.append((doc_ids[who], marks[who], code_of(anchor, buckets)))
                size += len(text)
                if size >= SHARD:
                    yield send(waiting)
                    waiting, size = [], 0
        if waiting:
            yield send(waiting)

    return cut


def by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, bytes]]]]:
    """Rows that are sorted by bucket, one bucket after the other; each must be read before the next."""
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    row = next(rows, None)
    while row is not None:
        bucket = row[0]

        def own() -> Iterator[tuple[int, bytes]]:
            nonlocal row
            while row is not None and row[0] == bucket:
                yield row[1], row[2]
                row = next(rows, None)

        mine = own()
        yield bucket, mine
        for _ in mine:
            pass


SHARED = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("code", pa.int64())])


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of the anchors that several documents have; of an anchor one row per shard is here."""

    def out(doc: np.ndarray, mark: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(mark), pa.array(code)], schema=SHARED)

    for bucket, entries in by_bucket(batches):
        if bucket < 0:
            for n, data in entries:
                doc, mark, code, _ = unpacked(data, n, "i8", "i8", "i8")
                yield out(np.cumsum(doc), mark, code)
            continue
        columns = [(np.cumsum(doc), mark, np.cumsum(low, dtype=np.uint32), known) for n, data in entries for doc, mark, low, known, _ in [unpacked(data, n, "i8", "i8", "u4", "?")]]
        doc, mark, low, known = (np.concatenate(c) for c in zip(*columns, strict=True))
        order = in_order(low)
        doc, mark, low, known = doc[order], mark[order], low[order], known[order]
        starts = groups(low)
        met = np.logical_or.reduceat(known, starts) | of_several(starts, doc) if len(low) else known
        take = spread(met, starts, len(low)) & ~known
        yield out(doc[take], mark[take], bucket << 32 | low[take].astype(np.int64))


# ---- step 2: pieces of these anchors

# Columns of the pieces of a row, before their bytes.
PIECE = ("i8", "i8", "i8", "u2", "u4")
SPAN = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("spans", pa.list_(pa.int64()))])


class Pieces:
    """Pieces that wait to be sent: document, mark, first place in the text, windows, code, and the bytes."""

    def __init__(self, depth: int) -> None:
        self.depth = depth
        self.columns: list[tuple[np.ndarray, ...]] = []
        self.texts: list[pa.Array] = []
        self.size = 0

    def add(self, text: np.ndarray, start: np.ndarray, windows: np.ndarray, *columns: np.ndarray) -> None:
        if not len(start):
            return
        sizes = windows + self.depth - 1
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1], dtype=np.int64)
        places += np.repeat(start - ends + sizes, sizes)
        self.texts.append(pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(text[places])]))
        doc, mark, place, code = columns
        self.columns.append((doc, mark, place, windows, code))
        self.size += int(ends[-1])

    def sent(self) -> pa.RecordBatch:
        """Of equal pieces those of the smallest document are dealt out; the others are repeats, which is told at once."""
        doc, mark, place, windows, code = (np.concatenate(c) for c in zip(*self.columns, strict=True))
        texts = pa.chunked_array(self.texts).combine_chunks()
        same = texts.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        first = np.full(int(same.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, same, doc)
        repeat = doc != first[same]
        rows = []
        if repeat.any():
            at = place[repeat]
            rows.append((-1 - int(code[0] & 0xFFFF), int(repeat.sum()), packed(steps(doc[repeat]), mark[repeat], at, at + windows[repeat] + self.depth - 1)))
        bucket = np.where(repeat, -1, code >> 32)
        order = np.argsort(bucket, kind="stable")[int(repeat.sum()) :]
        starts = groups(bucket[order])
        for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True):
            i = order[a:b]
            body = texts.take(pa.array(i))
            offsets = np.frombuffer(body.buffers()[1], np.int64)[body.offset : body.offset + len(i) + 1]
            content = np.frombuffer(body.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            rows.append((int(bucket[i[0]]), len(i), packed(steps(doc[i]), mark[i], place[i], windows[i].astype(np.uint16), code[i].astype(np.uint32), content)))
        self.columns, self.texts, self.size = [], [], 0
        return dealt(rows)


def of_text(code: np.ndarray, text: np.ndarray) -> np.ndarray:
    return mixed(code.view(np.uint64) * MIX[0] + text.astype(np.uint64))


def _piece_rows(depth: int, gram: int, buckets: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = Pieces(depth)
        for rows in batches:
            doc_ids, marks, codes = rows.column(0).to_numpy(zero_copy_only=False), rows.column(1).to_numpy(zero_copy_only=False), rows.column(3)
            counts = pc.list_value_length(codes).to_numpy(zero_copy_only=False)
            reach = np.append(0, np.cumsum(counts))
            wanted = of_text(pc.list_flatten(codes).to_numpy(zero_copy_only=False), np.repeat(np.arange(rows.num_rows), counts))
            for text, ends, owner, base in strips(texts_in(rows, 2), depth):
                start, windows, anchor = runs(text, ends, depth, gram)
                segment = np.searchsorted(ends, start, side="right")
                who, code = owner[segment], code_of(anchor, buckets)
                # a wrong match of two hashes sends a piece in vain and changes nothing
                take = np.isin(of_text(code, who), wanted[reach[owner[0]] : reach[owner[-1] + 1]])
                start, windows, segment, who, code = (c[take] for c in (start, windows, segment, who, code))
                begin = np.append(0, ends[:-1])[segment]
                waiting.add(text, start, windows, doc_ids[who], marks[who], start - begin + base[segment], code)
                if waiting.size >= SHARD_PIECES:
                    yield waiting.sent()
        if waiting.size:
            yield waiting.sent()

    return cut


# ---- step 3: merged transforms


def heads(symbols: np.ndarray) -> np.ndarray:
    """The first six symbols from each place on, of 257 values each, as one number."""
    padded = np.append(symbols, np.zeros(5, np.uint64))
    two = padded[:-1] * np.uint64(257) + padded[1:]
    four = two[:-2] * np.uint64(257**2) + two[2:]
    return four[:-2] * np.uint64(257**2) + two[4:]


def transform_order(head: np.ndarray) -> np.ndarray:
    """Places of one transform in the order of their suffixes, decided by the first ``CONTEXT`` symbols.

    Each round sorts numbers that hold two ranks and a place, and so doubles the symbols that the ranks stand for.
    """
    n, known = len(head), 6
    bits = np.uint64(n.bit_length())
    place = np.arange(n, dtype=np.uint64)
    rank = np.empty(n, np.uint64)
    key = head
    while True:
        key = key << bits | place
        key.sort()
        order = (key & ((ONE << bits) - ONE)).astype(np.int64)
        if known >= CONTEXT:
            return order
        key >>= bits
        new = np.zeros(n, np.uint64)
        new[1:] = key[1:] != key[:-1]
        ranks = np.cumsum(new)
        if int(ranks[-1]) == n - 1:
            return order
        rank[order] = ranks
        key = rank << bits
        key[: n - known] |= rank[known:] + ONE
        known *= 2


def merged_blocks(
    symbols: list[np.ndarray], earlier: list[np.ndarray], turns: list[int], doc: np.ndarray, rows: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Rows that share all symbols of the turns with a row of another document, and the starts of their blocks.

    ``rows`` is the interleave to begin with, one block: rows of all shards, in the order of each. Each turn refines it
    by the symbols before its rows, whose number is ``turns[i]``: ``symbols`` has them as one number and ``earlier`` the
    row that many symbols earlier in the same shard. ``doc`` names the document of a row. Inside a block rows stay in
    the order of their shards, so a number of symbols, block and row puts the interleave in its new order.
    """
    row_bits = np.uint64(len(doc).bit_length())
    block = np.zeros(len(rows), np.uint64)
    for turn in turns:
        if not len(rows):
            break
        block_bits = np.uint64(int(block[-1]).bit_length())
        key = symbols[turn][rows].astype(np.uint64) << (row_bits + block_bits)
        key |= block << row_bits
        key |= rows.astype(np.uint64)
        key.sort()
        rows = (key & ((ONE << row_bits) - ONE)).astype(np.int64)
        key >>= row_bits
        new = np.append(True, key[1:] != key[:-1])
        starts = np.flatnonzero(new)
        owner = doc[rows]
        other = np.append(False, owner[1:] != owner[:-1])
        other &= ~new
        several = np.logical_or.reduceat(other, starts)
        sizes = np.diff(np.append(starts, len(rows)))
        rows = earlier[turn][rows[np.repeat(several, sizes)]]
        block = np.repeat(np.arange(int(several.sum()), dtype=np.uint64), sizes[several])
    return rows, groups(block)


def turns_of(depth: int, rows: int, candidates: int) -> list[int]:
    """Symbols of each turn: as many as fit into a number beside a row and a block of two rows at least."""
    bits = 64 - rows.bit_length() - max(candidates // 2, 1).bit_length()
    most = max(1, min(bits // 8, 4, depth))
    return [most] * (depth // most) + [depth % most] * (depth % most > 0)


def repeated_windows(text: np.ndarray, sizes: np.ndarray, doc: np.ndarray, depth: int, longest: int = TRANSFORM) -> np.ndarray:
    """For the windows of all pieces in turn, whether a piece of a smaller document holds the same.

    Pieces come sorted by shard, one after the other in ``text``. A transform covers about ``longest`` symbols: a part of
    a large shard or several small ones.
    """
    n = len(text) + len(sizes)
    ends = np.cumsum(sizes + 1) - 1
    piece = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    left = (ends[piece] - np.arange(n)).astype(np.int32)
    spaced = np.zeros(n, np.uint8)  # end marks hold no symbol
    spaced[left > 0] = text
    # the rows of a transform follow those of the transforms before
    place = np.empty(n, np.int64)
    begins = (ends - sizes)[groups(ends // longest)].tolist()
    head = heads(np.where(left > 0, spaced.astype(np.uint64) + ONE, np.uint64(0)))
    for a, b in zip(begins, [*begins[1:], n], strict=True):
        place[a:b] = a + transform_order(head[a:b])
    row = np.empty(n, np.int32)
    row[place] = np.arange(n, dtype=np.int32)
    # a suffix becomes a window only if depth symbols of its piece are before it
    rows = np.flatnonzero((sizes[piece] - left >= depth)[place])
    turns = turns_of(depth, n, len(rows))
    symbols, earlier = [np.zeros(0, np.uint32)] * (max(turns) + 1), [np.zeros(0, np.int32)] * (max(turns) + 1)
    for turn in set(turns):
        before = np.zeros(n, np.uint32)
        for k in range(turn, 0, -1):
            before[k:] = before[k:] << np.uint32(8) | spaced[: n - k]
        back = np.zeros(n, np.int32)
        back[turn:] = row[: n - turn]
        symbols[turn], earlier[turn] = before[place], back[place]
    owner = np.unique(doc, return_inverse=True)[1].astype(np.int32)[piece][place]
    rows, starts = merged_blocks(symbols, earlier, turns, owner, rows)
    found = np.zeros(n, bool)
    if len(rows):
        least = np.minimum.reduceat(owner[rows], starts)
        found[place[rows]] = owner[rows] > spread(least, starts, len(rows))
    return found[left >= depth]


def removed_spans(doc: np.ndarray, mark: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Spans joined where they touch; one row per document."""
    order = np.lexsort((start, mark, doc))
    doc, mark, start, end = doc[order], mark[order], start[order], end[order]
    owners = groups(doc, mark)
    owner = spread(np.arange(len(owners)), owners, len(doc))
    reach = np.maximum.accumulate(end + owner * (1 << 40)) - owner * (1 << 40) if len(end) else end
    begin = np.append(True, (owner[1:] != owner[:-1]) | (start[1:] > reach[:-1])) if len(end) else np.zeros(0, bool)
    first = np.flatnonzero(begin)
    stops = reach[np.append(first[1:], len(end)) - 1] if len(first) else first
    flat = np.stack([start[first], stops], axis=1).ravel()
    counts = np.bincount(owner[first], minlength=len(owners))
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(2 * counts)), pa.int32()), pa.array(flat, pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(doc[owners], pa.int64()), pa.array(mark[owners], pa.int64()), lists], schema=SPAN)


def merged_pieces(text: np.ndarray, sizes: np.ndarray, doc: np.ndarray, mark: np.ndarray, place: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """Document, mark and place of the windows of these pieces that a smaller document holds too."""
    found = repeated_windows(text, sizes, doc, depth)
    windows = sizes - depth + 1
    piece = np.repeat(np.arange(len(sizes)), windows)
    inside = np.arange(len(found)) - np.repeat(np.cumsum(windows) - windows, windows)
    piece, inside = piece[found], inside[found]
    return doc[piece], mark[piece], place[piece] + inside


def _slices(text: np.ndarray, ends: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Bytes of the chosen pieces."""
    sizes = np.diff(np.append(0, ends))[chosen]
    after = np.cumsum(sizes)
    places = np.arange(after[-1] if len(after) else 0, dtype=np.int64)
    return text[places + np.repeat(ends[chosen] - after, sizes)]


SPANS_OR_PIECES = pa.schema([*SPAN, *DEALT])
SPANS_OR_PIECES_DDL = f"doc_id long, mark long, spans array<long>, {DEALT_DDL}"


def _both(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Spans or pieces as rows of one table, the columns of the other kind null."""
    have = dict(zip(rows.schema.names, rows.columns, strict=True))
    return pa.RecordBatch.from_arrays([have.get(f.name, pa.nulls(rows.num_rows, f.type)) for f in SPANS_OR_PIECES], schema=SPANS_OR_PIECES)


def _merge(depth: int, longer: int | None, buckets: int, largest: int, merged: int, one: int):
    """Spans of the repeats of each bucket; too large ones, and anchors too large by themselves, are cut at ``longer`` grams."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = Pieces(depth)

        def recut(text: np.ndarray, windows: np.ndarray, doc: np.ndarray, mark: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
            whole = np.cumsum(windows + depth - 1)
            part = groups(whole // STRIP)
            for a, b in zip(part, np.append(part[1:], len(whole)), strict=True):
                before = whole[a - 1] if a else 0
                ends = whole[a:b] - before
                strip = text[before : whole[b - 1]]
                start, size, anchor = runs(strip, ends, depth, longer)
                piece = np.searchsorted(ends, start, side="right")
                inside = start - np.append(0, ends[:-1])[piece]
                piece += a
                again.add(strip, start, size, doc[piece], mark[piece], place[piece] + inside, code_of(anchor, buckets))
                if again.size >= SHARD_PIECES:
                    yield _both(again.sent())

        for bucket, entries in by_bucket(batches):
            if bucket < 0:
                for n, data in entries:
                    doc, mark, start, end, _ = unpacked(data, n, "i8", "i8", "i8", "i8")
                    yield _both(removed_spans(np.cumsum(doc), mark, start, end))
                continue
            columns, size, over = [], 0, False
            for shard, (n, data) in enumerate(entries):
                doc, mark, place, windows, low, text = unpacked(data, n, *PIECE)
                columns.append((np.cumsum(doc), mark, place, windows.astype(np.int64), low, np.full(n, shard), text))
                size += len(text)
                if longer and (over or size > largest):
                    over = True
                    for doc, mark, place, windows, _, _, text in columns:
                        yield from recut(text, windows, doc, mark, place)
                    columns = []
            if not columns:
                continue
            doc, mark, place, windows, low, shard, text = (np.concatenate(c) for c in zip(*columns, strict=True))
            del columns
            ends, order = np.cumsum(windows + depth - 1), in_order(low)
            starts = groups(low[order])
            order = order[spread(of_several(starts, doc[order]), starts, len(low))]
            if not len(order):
                continue
            # anchors are merged together up to a size; one that is larger is cut again
            sizes = (windows + depth - 1)[order]
            starts = groups(low[order])
            total = np.add.reduceat(sizes, starts)
            bounds = np.append(starts, len(order))
            reach = np.append(0, np.cumsum(total))
            at, told = 0, []
            while at < len(starts):
                stop = max(at + 1, int(np.searchsorted(reach, reach[at] + merged, side="right")) - 1)
                i = order[bounds[at] : bounds[stop]]
                if longer and reach[stop] - reach[at] > one:
                    yield from recut(_slices(text, ends, i), windows[i], doc[i], mark[i], place[i])
                else:
                    i = i[np.argsort(shard[i], kind="stable")]
                    told.append(merged_pieces(_slices(text, ends, i), windows[i] + depth - 1, doc[i], mark[i], place[i], depth))
                at = stop
            if told:
                doc, mark, place = (np.concatenate(c) for c in zip(*told, strict=True))
                yield _both(removed_spans(doc, mark, place, place + depth))
        if again.size:
            yield _both(again.sent())

    return merge


def repeated_spans(texts: DataFrame, depth: int = DEPTH, gram: int = GRAM, bucket: int = BUCKET, largest: int = LARGEST, merged: int = MERGED) -> DataFrame:
    """``doc_id, mark, spans``: places (start, end, start, end, ...) of repeats, in one or more rows per document.

    ``texts`` has ``doc_id`` and ``mark``, which together name a text, and ``text``.
    """
    if not 0 < gram <= depth:
        raise ValueError("a gram is not longer than a window")
    texts = texts.select("doc_id", "mark", "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    entries = max(1, -(-size // bucket))  # an anchor takes about a byte per byte of text
    shared = (
        texts.mapInArrow(_anchor_rows(depth, gram, entries), DEALT_DDL)
        .repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_shared_anchors, "doc_id long, mark long, code long")
        .groupBy("doc_id", "mark").agg(F.collect_list("code").alias("codes"))
    )
    level = texts.join(shared, ["doc_id", "mark"]).select("doc_id", "mark", "text", "codes").mapInArrow(_piece_rows(depth, gram, entries), DEALT_DDL)
    found = None
    grams = sorted({gram, min(2 * gram, depth), depth})
    parts = min(64 * entries, 1 << 30)
    for i, _ in enumerate(grams):
        longer = grams[i + 1] if i + 1 < len(grams) else None
        rows = stage(
            level.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge(depth, longer, parts, largest, merged, ANCHOR * merged // MERGED), SPANS_OR_PIECES_DDL),
            "repeats",
        )
        spans = rows.where(F.col("doc_id").isNotNull()).select("doc_id", "mark", "spans")
        found = spans if found is None else found.unionByName(spans)
        level = rows.where(F.col("bucket").isNotNull()).select("bucket", "n", "data")
        if longer is None or level.isEmpty():
            return found


def _kept(text: bytes, spans: list[list[int]]) -> tuple[bytes, list[int]]:
    """What is left of a text, and the maximal spans that went."""
    pairs = sorted((a, b) for s in spans for a, b in zip(s[::2], s[1::2], strict=True))
    joined: list[int] = []
    for a, b in pairs:
        if joined and a <= joined[-1]:
            joined[-1] = max(joined[-1], b)
        else:
            joined += [a, b]
    cuts = [0, *joined, len(text)]
    return b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)), joined


def _removal(text: Column, spans: Column) -> Column:
    @F.arrow_udf("struct<kept: binary, spans: array<long>>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        kept = [_kept(t or b"", s or []) for t, s in zip(texts.cast(pa.binary()).to_pylist(), spans.to_pylist(), strict=True)]
        return pa.StructArray.from_arrays(
            [pa.array([k for k, _ in kept], pa.binary()), pa.array([s for _, s in kept], pa.list_(pa.int64()))], names=["kept", "spans"]
        )

    return cut(text, spans)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, gram: int = GRAM, bucket: int = BUCKET, largest: int = LARGEST, merged: int = MERGED
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, kept, spans``; spans are the maximal removed runs of bytes, as start, end, start, end.

    A byte goes if it lies in a string of ``depth`` bytes that also starts in a
    document with a smaller identifier. Null texts count as empty; texts shorter
    than ``depth`` stay whole. Rows that repeat an identifier are the same
    document: they take nothing from each other, and each is judged by its own
    text. Rows without an identifier are neither smaller nor larger than others
    and stay whole. ``kept`` is bytes, as a cut may fall inside a character.
    Other columns are ignored; an empty table gives an empty result.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    named = rows.where(F.col("doc_id").isNotNull())
    several = not named.groupBy("doc_id").count().where("count > 1").isEmpty()
    # a hash of the text tells rows of one identifier apart; without such rows nothing has to
    marked = rows.withColumn("mark", F.xxhash64("text") if several else F.lit(0).cast("long"))
    has_id = F.col("doc_id").isNotNull()
    spans = repeated_spans(marked.where(has_id & (F.octet_length("text") >= depth)), depth, gram, bucket, largest, merged)
    per_text = spans.groupBy("doc_id", "mark").agg(F.collect_list("spans").alias("spans"))
    judged = marked.where(has_id).join(per_text, ["doc_id", "mark"], "left").select("doc_id", "text", "spans")
    unnamed = marked.where(~has_id).select("doc_id", "text", F.lit(None).cast("array<array<bigint>>").alias("spans"))
    return judged.unionByName(unnamed).withColumn("cut", _removal(F.col("text"), F.col("spans"))).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.col("cut.kept").alias("kept"), F.col("cut.spans").alias("spans")
    )
