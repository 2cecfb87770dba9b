"""Scores of documents by masked pseudo-likelihood, with a vocabulary that grows with the corpus.

Every token is predicted from the two tokens on either side by a small network:
an embedding of each neighbour, a matrix per place of the window, one hidden
layer, and a softmax of two levels: a group of classes, then a class of that
group, so a token costs about twice the root of the number of classes. The score
of a document is the sum over its tokens of the log-probability of the token
given its neighbours.

The vocabulary is every word that occurs ``LEAST`` times; each has an embedding
of its own. The softmax is over classes, whose number grows with the root of
the vocabulary: frequent words by themselves, the others by ending. Inside a
class a word has its share of the class' occurrences, so every word has a
probability of its own. Rarer words are one entry, times the probability of
their spelling by pairs of bytes; that is never zero.

Spark counts the words and stages every document as token numbers. Pieces of
about ``SAMPLE`` tokens, chosen by hash from anywhere in any text, give the network
its starting values only; then every task walks all of its documents, and what it
changed is averaged: embeddings by how often the task met the word, the rest by
tokens. A task sends the embeddings of words it met, so what is sent grows with the
text and not with tasks times vocabulary; it is added up in two turns, so no block
of values meets the records of all tasks at once.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import pick
from newsloom.sources.writers import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Token numbers: 0 stands outside of a text, 1 for a rare word, then the vocabulary.
REST = 1
LEAST = 5
# Longer words (bytes) are spelled, whatever their number: none of them enters the broadcast vocabulary.
LONGEST = 64
# Classes besides one for each unit of the root of the vocabulary: words by themselves, endings.
OWN, ENDINGS = 64, 24
EMBEDDING, HIDDEN = 16, 32
PLACES = (0, 1, 3, 4)
# Tokens of a step: of the sample, and of the documents.
START, BATCH = 4096, 16384
RATE = 0.05
# Tokens of the sample the starting values come from, and how often they are walked.
SAMPLE, WALKS = 400_000, 6
PIECE = 4_000  # characters of a piece of the sample
# A class that fills up a group has this as its base, and with it no probability.
NEVER = -60.0
# Embeddings in a block of changes, blocks in a record batch.
BLOCK, RECORDS = 1024, 128
REMEMBER = 1_000_000
# Bytes of texts, or of token numbers, that are worked on together.
CHUNK, WORDS_CHUNK = 1_000_000, 4_000_000
SPACE = 0x20


@dataclass
class Vocabulary:
    words: list[bytes]
    counts: np.ndarray  # of the words
    rest: int
    spelling: np.ndarray  # log-probability [byte, next byte]; a space begins and ends a word


def _bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for text in texts:
        if size and size + len(text) > CHUNK:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


COUNTED = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def _words(column: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Of several texts at a time: their different words, the places of their words among these, and words per text."""
    lengths = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))])
    cuts = np.unique(np.searchsorted(lengths, np.arange(WORDS_CHUNK, lengths[-1], WORDS_CHUNK)))
    for a, b in zip([0, *cuts], [*cuts, len(column)], strict=True):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column.slice(a, b - a), "")))
        flat, ends = lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy())
        full = pc.greater(pc.binary_length(flat), 0)
        kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
        told = flat.filter(full).dictionary_encode()
        yield told.dictionary.cast(pa.binary()), told.indices.to_numpy(), np.diff(kept[ends], prepend=0)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their number; the empty word stands for all that are too long."""
    tables, size = [], 0

    def merged() -> pa.Table:
        return pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(COUNTED.names)

    for rows in batches:
        for words, places, _ in _words(rows.column(0)):
            short = pc.if_else(pc.less_equal(pc.binary_length(words), LONGEST), words, pa.scalar(b"", pa.binary()))
            tables.append(pa.table([short, pa.array(np.bincount(places, minlength=len(words)))], schema=COUNTED))
            size += len(words)
            if size > REMEMBER:
                tables = [merged()]
                size = len(tables[0])
                if size > REMEMBER // 2:
                    yield from tables[0].to_batches()
                    tables, size = [], 0
    if tables:
        yield from merged().to_batches()


def pairs_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Cells [byte, next byte] of all words, and where each word begins among them."""
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])[:-1]]).astype(np.int64)
    return data[:-1] * 256 + data[1:], starts


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256 * 256, np.int64)
    for rows in batches:
        words, n = rows.column(0).to_pylist(), rows.column(1).to_numpy()
        if words:
            cells, starts = pairs_of(words)
            np.add.at(total, cells, np.repeat(n, np.diff(np.append(starts, len(cells)))))
    cells = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], schema=pa.schema([("cell", pa.int64()), ("n", pa.int64())]))


def spelling_of(pairs: np.ndarray) -> np.ndarray:
    """Log-probabilities of the next byte; a word has a byte at least, and any byte may follow any."""
    seen = pairs.reshape(256, 256) + 0.01
    seen[SPACE, SPACE] = 0
    with np.errstate(divide="ignore"):
        return np.log(seen / seen.sum(axis=1, keepdims=True))


def vocabulary(docs: DataFrame, least: int = LEAST) -> Vocabulary:
    """Every word of ``least`` occurrences, the most frequent first, and the spelling of the others."""
    counted = stage(docs.select("text").mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    known = (F.col("n") >= least) & (F.length("word") > 0)
    kept = counted.where(known).toArrow().to_pydict()
    order = sorted(zip(kept["n"], kept["word"], strict=True), key=lambda x: (-x[0], x[1]))
    rare = counted.where(~known)
    pairs = np.zeros(256 * 256)
    for r in rare.where(F.length("word") > 0).mapInArrow(count_pairs, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        pairs[r["cell"]] = r["n"]
    rest = rare.agg(F.sum("n")).first()[0] or 0
    return Vocabulary([w for _, w in order], np.array([n for n, _ in order], np.int64), rest, spelling_of(pairs))


def classes(known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Class of every token number, and log share of the token in its class. Outside of texts there is none."""
    size, root = len(known.words), math.isqrt(len(known.words))
    own = min(size, OWN + root)
    endings = ENDINGS + root // 2
    of = np.zeros(size + 2, np.int64)
    of[2 : own + 2] = np.arange(1, own + 1)
    of[own + 2 :] = [1 + own + zlib.crc32(w[-2:]) % endings for w in known.words[own:]]
    used = np.unique(of[1:], return_inverse=True)[1]  # no class without words
    of[1:] = used
    n = np.concatenate([[0, known.rest], known.counts]).astype(float)
    share = np.zeros(size + 2)
    share[2:] = np.log(n[2:] / np.bincount(of[1:], n[1:])[of[2:]])
    return of, share


def layout(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Group of each of ``k`` classes, and its place there; groups are runs of classes of nearly one length."""
    groups = min(k, math.isqrt(k) + 1)
    group = np.arange(k) * groups // k
    return group, np.arange(k) - np.searchsorted(group, np.arange(groups))[group]


def _errors(x: np.ndarray, right: np.ndarray, safe: bool) -> np.ndarray:
    """Probabilities less one at the right place, over the number of rows."""
    if not safe:
        x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x *= 1 / (len(x) * x.sum(axis=1, keepdims=True))
    x[np.arange(len(x)), right] -= 1 / len(x)
    return x


class Network:
    """Values of the network; ``rows`` are the embeddings, all others are in ``dense``.

    ``dense``: a matrix per place and the base of the hidden layer, the matrix and
    base of the groups, and the matrices and bases of the classes in each group.
    """

    def __init__(self, rows: np.ndarray, dense: list[np.ndarray], squares: tuple[np.ndarray, list[np.ndarray]], k: int):
        self.rows, self.dense, self.squares, self.k = rows, dense, squares, k
        self.group, self.member = layout(k)

    def copy(self) -> Network:
        return Network(self.rows.copy(), [d.copy() for d in self.dense], (self.squares[0].copy(), [s.copy() for s in self.squares[1]]), self.k)

    def _hidden(self, row: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of the tokens in order of their group, classes, neighbours and hidden layer there."""
        at = np.flatnonzero(row[2:-2])
        right = of[row[2 + at]]
        order = np.argsort(self.group[right].astype(np.int16), kind="stable")
        at, right = at[order], right[order]
        around = self.rows[row[at[:, None] + PLACES]].reshape(len(at), 4 * EMBEDDING)
        h = around @ self.dense[0].reshape(4 * EMBEDDING, HIDDEN)
        h += self.dense[1]
        return at, right, around, np.tanh(h, out=h)

    def _outputs(self, right: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Outputs of the groups, those of the classes of the right group, and the run of tokens of each group."""
        group = self.group[right]
        x = h @ self.dense[2]
        x += self.dense[3]
        used, first = np.unique(group, return_index=True)
        runs = list(zip(used.tolist(), first.tolist(), [*first[1:].tolist(), len(group)], strict=True))
        y = np.empty((len(h), self.dense[5].shape[1]), np.float32)
        for g, a, b in runs:
            np.matmul(h[a:b], self.dense[4][g], out=y[a:b])
            y[a:b] += self.dense[5][g]
        return x, y, runs

    def _safe(self) -> bool:
        """Whether no output can leave the range of exp in single precision: hidden values lie between -1 and 1."""
        return all((np.abs(w).sum(axis=-2) + np.abs(b)).max() < 80 for w, b in (self.dense[2:4], self.dense[4:6]))

    def log_chances(self, row: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of tokens in ``row`` (less two at either end), and the log-probability of the class of each."""
        at, right, _, h = self._hidden(row, of)
        if not len(at):
            return at, np.zeros(0, np.float32)
        x, y, _ = self._outputs(right, h)
        here, chance, safe = np.arange(len(at)), np.zeros(len(at), np.float32), self._safe()
        for values, chosen in ((x, self.group[right]), (y, self.member[right])):
            if not safe:
                values -= values.max(axis=1, keepdims=True)
            chance += values[here, chosen]
            chance -= np.log(np.exp(values, out=values).sum(axis=1))
        order = np.argsort(at)
        return at[order], chance[order]

    def step(self, row: np.ndarray, of: np.ndarray, rate: float = RATE) -> None:
        """One step down the gradient of the windows of ``row``, which has two places more at either end."""
        at, right, around, h = self._hidden(row, of)
        if not len(at):
            return
        x, y, runs = self._outputs(right, h)
        safe = self._safe()
        x, y = _errors(x, self.group[right], safe), _errors(y, self.member[right], safe)
        place, _, groups, _, members, bases = self.dense
        back = x @ groups.T
        inside, below = np.zeros_like(members), np.zeros_like(bases)
        for g, a, b in runs:
            back[a:b] += y[a:b] @ members[g].T
            np.matmul(h[a:b].T, y[a:b], out=inside[g])
            below[g] = y[a:b].sum(axis=0)
        back *= 1 - h * h
        down = back @ place.reshape(4 * EMBEDDING, HIDDEN).T
        grads = [(around.T @ back).reshape(place.shape), back.sum(axis=0), h.T @ x, x.sum(axis=0), inside, below]
        for p, g, s in zip(self.dense, grads, self.squares[1], strict=True):
            s += g * g
            p -= rate * g / (np.sqrt(s) + 1e-8)
        each = np.zeros((len(row), EMBEDDING), np.float32)
        for i, p in enumerate(PLACES):
            each[at + p] += down[:, i * EMBEDDING : (i + 1) * EMBEDDING]
        order = np.argsort(row, kind="stable")
        met = row[order]
        first = np.flatnonzero(np.diff(met, prepend=-1))
        g, met = np.add.reduceat(each[order], first), met[first]
        self.squares[0][met] += (g * g).mean(axis=1)
        self.rows[met] -= rate * g / (np.sqrt(self.squares[0][met])[:, None] + 1e-8)

    def walk(self, row: np.ndarray, of: np.ndarray, batch: int) -> None:
        for a in range(0, len(row) - 4, batch):
            self.step(row[a : a + batch + 4], of)


def new_network(known: Vocabulary, of: np.ndarray, seed: int = 0) -> Network:
    """Random values, but for the bases: the share of each group in all tokens, and of each class in its group."""
    rng, k = np.random.default_rng(seed), int(of.max()) + 1
    n = np.bincount(of[1:], np.concatenate([[known.rest], known.counts]), minlength=k) + 0.5
    rows = rng.normal(0, 0.3, (len(of), EMBEDDING)).astype(np.float32)
    group, member = layout(k)
    sums = np.bincount(group, n)
    bases = np.full((len(sums), member.max() + 1), NEVER)
    bases[group, member] = np.log(n / sums[group])
    dense = [rng.normal(0, 0.3, (4, EMBEDDING, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, (HIDDEN, len(sums))), np.log(sums / sums.sum())]
    dense += [rng.normal(0, 0.1, (len(sums), HIDDEN, bases.shape[1])), bases]
    dense = [d.astype(np.float32) for d in dense]
    return Network(rows, dense, (np.full(len(of), 1e-8, np.float32), [np.full_like(d, 1e-8) for d in dense]), k)


def numbered(texts: list[bytes], numbers: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Tokens of all texts with two outside places around each, tokens per text, and the rare words in order."""
    row, counts, rare = [0, 0], [], []
    for text in texts:
        words = text.lower().split()
        counts.append(len(words))
        found = [numbers.get(w, REST) for w in words]
        if REST in found:
            rare += [w for w, i in zip(words, found, strict=True) if i == REST]
        row += found
        row += (0, 0)
    return np.array(row, np.int64), np.array(counts, np.int64), rare


def numbers_of(words: list[bytes]) -> dict[bytes, int]:
    return {w: i + 2 for i, w in enumerate(words)}


def _sample(docs: DataFrame, total: int) -> list[bytes]:
    """Pieces of about ``SAMPLE`` tokens, by hash from all places of all texts, in order."""
    limit = int(min(1.0, SAMPLE / max(total, 1)) * (1 << 30))
    starts = F.sequence(F.lit(0), F.greatest(F.length("text") - 1, F.lit(0)), F.lit(PIECE))
    chosen = F.filter(starts, lambda i: F.pmod(F.xxhash64("doc_id", i), F.lit(1 << 30)) < limit)
    rows = docs.where("text is not null").select("text", F.explode(chosen).alias("i")).select(F.substring("text", F.col("i") + 1, F.lit(PIECE)).alias("text"))
    return sorted(t.encode() for t in rows.toArrow().column(0).to_pylist())


def started(texts: list[bytes], known: Vocabulary, of: np.ndarray) -> Network:
    net = new_network(known, of)
    row, _, _ = numbered(texts, numbers_of(known.words))
    for _ in range(WALKS):
        net.walk(row, of, START)
    return net


NUMBERED = pa.schema([("doc_id", pa.int64()), ("tokens", pa.binary()), ("spelled", pa.float64())])
NUMBERED_SQL = "doc_id long, tokens binary, spelled double"


def _per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over the tokens of each text, of values in the places of ``numbered``."""
    sums = np.concatenate([[0], np.cumsum(values)])
    starts = np.concatenate([[0], np.cumsum(counts + 2)])[:-1]
    return sums[starts + counts] - sums[starts]


def spell(words: list[bytes], spelling: np.ndarray) -> np.ndarray:
    """Log-probability of the spelling of each word."""
    if not words:
        return np.zeros(0)
    cells, starts = pairs_of(words)
    return np.add.reduceat(spelling.ravel()[cells], starts)


def spelled(row: np.ndarray, counts: np.ndarray, rare: list[bytes], spelling: np.ndarray) -> np.ndarray:
    """Log-probability of the spelling of the rare words of each text."""
    values = np.zeros(len(row) - 4)
    values[row[2:-2] == REST] = spell(rare, spelling)
    return _per_text(values, counts)


def number_documents(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Every document as token numbers (four bytes each), and what the spelling of its rare words comes to; staged."""
    sent = docs.sparkSession.sparkContext.broadcast((known.words, known.spelling))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, spelling = sent.value
        numbers = numbers_of(words)
        for rows in batches:
            at = 0
            for different, places, counts in _words(rows.column(1)):
                words = different.to_pylist()
                found = np.fromiter((numbers.get(w, REST) for w in words), np.dtype("<i4"), len(words))
                rare = np.flatnonzero(found == REST)
                chance = np.zeros(len(words))
                chance[rare] = spell([words[i] for i in rare], spelling)
                sums = np.concatenate([[0], np.cumsum(chance[places])])
                starts = np.concatenate([[0], np.cumsum(counts)])
                tokens = found[places]
                each = [tokens[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                columns = [rows.column(0).slice(at, len(counts)), pa.array(each, pa.binary()), pa.array(np.diff(sums[starts]))]
                yield pa.RecordBatch.from_arrays(columns, schema=NUMBERED)
                at += len(counts)

    staged = stage(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(number, NUMBERED_SQL), "tokens")
    sent.destroy()
    return staged


def _rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of several documents as ``numbered`` has them, and tokens per document."""
    edge = np.zeros(2, np.int64)
    for part in _chunks(_bytes(column)):
        tokens = [np.frombuffer(t, "<i4") for t in part]
        yield np.concatenate([edge, *(x for t in tokens for x in (t, edge))]), np.array([len(t) for t in tokens], np.int64)


MERGED = pa.schema([("block", pa.int64()), ("at", pa.binary()), ("weight", pa.binary()), ("value", pa.binary())])
MERGED_SQL = "block long, at binary, weight binary, value binary"


def _pack(block: int, weight: np.ndarray, value: np.ndarray) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """A record of the rows of a block that have weight: their places, weights and values in half precision."""
    at = np.flatnonzero(weight)
    if len(at):
        yield block, at.astype(np.uint16).tobytes(), weight[at].astype(np.float32).tobytes(), value[at].astype(np.float16).tobytes()


def changes(net: Network, start: Network, met: np.ndarray, tokens: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """What a task changed: embeddings it met in blocks, weighed by how often, and all else in negative blocks, by tokens."""
    for b in range(0, len(met), BLOCK):
        yield from _pack(b // BLOCK, met[b : b + BLOCK], net.rows[b : b + BLOCK] - start.rows[b : b + BLOCK])
    dense = _columns(np.concatenate([d.ravel() - s.ravel() for d, s in zip(net.dense, start.dense, strict=True)]))
    for b in range(0, len(dense), BLOCK):
        yield from _pack(-1 - b // BLOCK, np.full(len(dense[b : b + BLOCK]), float(tokens)), dense[b : b + BLOCK])


def _columns(values: np.ndarray) -> np.ndarray:
    return np.pad(values, (0, -len(values) % EMBEDDING)).reshape(-1, EMBEDDING)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), MERGED, strict=True)], schema=MERGED)


def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One record per block: the weighted mean of the changes, and the sum of the weights, so that means can be averaged again."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for rows in batches:
        for block, at, weight, value in zip(*(rows.column(f.name).to_pylist() for f in MERGED), strict=True):
            at, weight = np.frombuffer(at, np.uint16), np.frombuffer(weight, np.float32)
            if block not in sums:
                sums[block] = np.zeros(BLOCK), np.zeros((BLOCK, EMBEDDING))
            sums[block][0][at] += weight
            sums[block][1][at] += weight[:, None] * np.frombuffer(value, np.float16).reshape(len(at), -1)
    for block, (weight, value) in sums.items():
        yield _record(list(_pack(block, weight, value / np.maximum(weight, 1e-30)[:, None])))


def train(docs: DataFrame, known: Vocabulary, of: np.ndarray, tokens: DataFrame | None = None) -> Network:
    """The network after every task has walked its documents once; ``tokens`` are those of ``number_documents``."""
    tokens = number_documents(docs, known) if tokens is None else tokens
    net = started(_sample(docs, int(known.counts.sum()) + known.rest), known, of)
    sent = tokens.sparkSession.sparkContext.broadcast((of, net))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, start = sent.value
        mine, met, n = None, np.zeros(len(of)), 0
        for rows in batches:
            for row, counts in _rows(rows.column(0)):
                mine = mine or start.copy()
                mine.walk(row, of, BATCH)
                met += np.bincount(row, minlength=len(of))
                n += int(counts.sum())
        if n:
            records = changes(mine, start, met, n)
            while some := list(islice(records, RECORDS)):
                yield _record(some)

    parts = tokens.select("tokens").mapInArrow(walk, MERGED_SQL)
    # a frequent block has a record from every task: tasks are first added up in as many lots as the root of the number of files
    lots = max(1, math.isqrt(len(tokens.inputFiles())))
    near = parts.withColumn("lot", F.spark_partition_id() % lots).repartition("block", "lot").mapInArrow(average, MERGED_SQL)
    merged = stage(near.repartition("block").mapInArrow(average, MERGED_SQL), "network")
    end, dense = net.copy(), _columns(np.concatenate([d.ravel() for d in net.dense]))
    for r in merged.toLocalIterator():
        at, value = np.frombuffer(r["at"], np.uint16), np.frombuffer(r["value"], np.float16)
        into, block = (end.rows, r["block"]) if r["block"] >= 0 else (dense, -1 - r["block"])
        into[block * BLOCK + at.astype(np.int64)] += value.reshape(len(at), -1)
    cuts = np.cumsum([d.size for d in net.dense])
    end.dense = [v.reshape(d.shape) for v, d in zip(np.split(dense.ravel()[: cuts[-1]], cuts[:-1]), net.dense, strict=True)]
    sent.destroy()
    return end


def score_row(row: np.ndarray, counts: np.ndarray, of: np.ndarray, share: np.ndarray, net: Network) -> np.ndarray:
    """Summed log-probability of each text but for the spelling of rare words."""
    values = share[row[2:-2]]
    for a in range(0, len(values), BATCH):
        at, chance = net.log_chances(row[a : a + BATCH + 4], of)
        values[a + at] += chance
    return _per_text(values, counts)


def score_texts(
    texts: list[bytes], numbers: dict[bytes, int], of: np.ndarray, share: np.ndarray, spelling: np.ndarray, net: Network
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and summed log-probability of each text."""
    row, counts, rare = numbered(texts, numbers)
    return counts, score_row(row, counts, of, share, net) + spelled(row, counts, rare, spelling)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``doc_id, n_tokens, log_prob, mean_log_prob`` of every row, by a network trained on all of them.

    Tokens are words between ASCII white space, A-Z lowered. Null and empty texts
    have no tokens, a sum of zero and no mean. Rows that repeat are scored alike.
    An empty table gives an empty result. Other columns are ignored.
    """
    texts = pick(docs, doc_id=id_col, text=text_col)
    known = vocabulary(texts, least)
    of, share = classes(known)
    tokens = number_documents(texts, known)
    net = train(texts, known, of, tokens)
    net.squares = (np.zeros(0), [])
    sent = docs.sparkSession.sparkContext.broadcast((of, share, net))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("log_prob", pa.float64())])
        for rows in batches:
            at = 0
            for row, counts in _rows(rows.column(1)):
                sums = score_row(row, counts, *sent.value) + rows.column(2).slice(at, len(counts)).to_numpy()
                yield pa.RecordBatch.from_arrays([rows.column(0).slice(at, len(counts)), pa.array(counts), pa.array(sums)], schema=schema)
                at += len(counts)

    scored = tokens.mapInArrow(score, "doc_id long, n_tokens long, log_prob double")
    return scored.withColumn("mean_log_prob", F.try_divide("log_prob", "n_tokens"))
