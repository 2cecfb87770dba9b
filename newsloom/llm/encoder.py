"""Token ids of whole texts by the tokenizers library, with each distinct piece encoded once.

A byte-level tokenizer of the usual pattern never joins white space to what
stands before it, nor a sign to a letter before it. A text therefore falls into
pieces, cut before each run of white space and between a letter and a sign,
whose ids stand side by side in the ids of the whole text. A worker remembers
the ids of the pieces it has met. Short pieces are looked up all at once, as
pairs of whole numbers that hold their bytes and their length.
"""

from __future__ import annotations

import os
import string
import sys
import types
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pieces a worker remembers, and ids for each; beyond that it forgets the rare ones, so its memory stays bounded.
REMEMBER = 600_000
IDS_EACH = 8
# Pieces that are encoded as one text.
TOGETHER = 200
# Bytes of a piece that fit two whole numbers of eight bytes, besides the length.
SHORT = 15

WHITE, LETTER, SIGN, LATIN, WIDE = 1, 2, 3, 4, 5
KINDS = np.zeros(256, np.uint8)
KINDS[[*b" \t\n\v\f\r"]] = WHITE
KINDS[[*string.ascii_letters.encode()]] = LETTER
KINDS[[*string.punctuation.encode()]] = SIGN
# first bytes of the letters from U+00C0 to U+023F, and of white space beyond ASCII
KINDS[0xC3:0xC9] = LATIN
KINDS[[0xC2, 0xE1, 0xE2, 0xE3]] = WIDE
SPACES = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
# A mask for each number of bytes.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
# The letter that stands for each byte: its own if it can be seen, else one from 256 on, in order.
SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
LETTERS = np.zeros(256, np.uint16)
LETTERS[SEEN] = SEEN
LETTERS[LETTERS == 0] = range(256, 512 - len(SEEN))


def _wider(values: np.ndarray, size: int) -> np.ndarray:
    while size > len(values):
        values = np.concatenate([values, np.zeros_like(values)])
    return values


def _bytes(texts: pa.Array | Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, with some more behind them, and where each text begins and ends."""
    held = pc.fill_null(pa.array(texts, pa.string()) if not isinstance(texts, pa.Array) else texts, "").cast(pa.large_string())
    _, bounds, data = held.buffers()
    if not len(held) or data is None:
        return np.zeros(16, np.uint8), np.zeros(len(held) + 1, np.int64)
    bounds = np.frombuffer(bounds, np.int64)[held.offset : held.offset + len(held) + 1]
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    return np.append(data, np.zeros(16, np.uint8)), bounds - bounds[0]


def _kinds(data: np.ndarray) -> np.ndarray:
    """What each byte belongs to: white space, a letter, a sign or something else."""
    kinds = KINDS[data]
    latin = np.flatnonzero(kinds == LATIN)
    # two signs lie among the letters
    latin = latin[(data[latin] != 0xC3) | ((data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7))]
    kinds[latin] = kinds[latin + 1] = LETTER
    wide = np.flatnonzero(kinds == WIDE)
    codes = (data[wide].astype(np.int64) << 16) | (data[wide + 1].astype(np.int64) << 8) | data[wide + 2]
    for n, found in ((2, codes >> 8), (3, codes)):
        for at in range(n):
            kinds[wide[np.isin(found, [int.from_bytes(s) for s in SPACES if len(s) == n])] + at] = WHITE
    return kinds


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of all elements of spans, span by span."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class PieceEncoder:
    """``encode(texts)`` gives (ids of all texts in a row, ids per text); a text that is null is empty."""

    def __init__(self, path: str, end: int | None = None, remember: int = REMEMBER):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # strings of special tokens inside a text are ordinary text
        self.tokenizer.encode_special_tokens = True
        # for words that the pattern does not cut, given in the letters of their bytes
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.end, self.remember = end, remember
        vocabulary = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.lengths[number] = len(token)  # one letter stands for one byte
        self._start()

    def _start(self) -> None:
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0
        self.starts, self.sizes = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)
        self.uses = np.zeros(1, np.int64)
        self.count = 1
        # a place of the table holds the two halves of a piece, and its number; no piece has an empty second half
        self.low, self.high, self.number = np.zeros(1 << 15, np.uint64), np.zeros(1 << 15, np.uint64), np.zeros(1 << 15, np.int32)
        self.long: dict[bytes, int] = {}
        # piece 0 ends a text
        self._store(np.zeros(1, np.int64), np.array([] if self.end is None else [self.end], np.int32), np.array([self.end is not None], np.int64))

    def _forget(self) -> None:
        """Keep the pieces met most often since the last time, at most half of the bounds."""
        least = 2
        while (kept := self.uses >= least).sum() > self.remember // 2 or self.sizes[: self.count][kept].sum() > self.remember * IDS_EACH // 2:
            least *= 2
        kept = np.union1d([0], np.flatnonzero(kept))
        # in parts: positions of ids take more memory than the ids
        ids, sizes = map(np.concatenate, zip(*map(self._gather, np.array_split(kept, 50)), strict=True))
        number = np.zeros(self.count, np.int32)
        number[kept] = np.arange(len(kept))
        held = np.flatnonzero(number[self.number])
        low, high, numbers, before = self.low[held], self.high[held], number[self.number[held]], self.long
        self._start()
        self.count, self.used = len(kept), 0
        self._store(np.arange(len(kept)), ids, sizes)
        self._place(low, high, numbers)
        self.long = {key: int(number[n]) for key, n in before.items() if number[n]}

    def _store(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids = _wider(self.ids, self.used + len(ids))
        self.starts, self.sizes = _wider(self.starts, self.count), _wider(self.sizes, self.count)
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[numbers] = self.used + np.cumsum(sizes) - sizes
        self.sizes[numbers] = sizes
        self.used += len(ids)

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces in a row, and how many each has."""
        sizes = self.sizes[numbers]
        return self.ids[_spans(self.starts[numbers], sizes)], sizes

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of each piece in the table, or the free one where it belongs."""
        mixed = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        at = (mixed >> np.uint64(64 - (len(self.low).bit_length() - 1))).astype(np.int64)
        left = np.flatnonzero((self.low[at] != low) | (self.high[at] != high))
        while len(left := left[self.high[at[left]] != 0]):
            at[left] = (at[left] + 1) & (len(self.low) - 1)
            left = left[(self.low[at[left]] != low[left]) | (self.high[at[left]] != high[left])]
        return at

    def _place(self, low: np.ndarray, high: np.ndarray, numbers: np.ndarray | None = None) -> np.ndarray:
        """Puts pieces into the table, under the numbers given or new ones; positions of the first of each kind."""
        size, held = len(self.low), self.count + (len(low) if numbers is None else 0)
        while 3 * held > 2 * size:
            size *= 2
        if size > len(self.low):
            held = np.flatnonzero(self.number)
            before = self.low[held], self.high[held], self.number[held]
            self.low, self.high, self.number = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.zeros(size, np.int32)
            self._place(*before)
        placed, left = [], np.arange(len(low))
        while len(left):
            at = self._find(low[left], high[left])
            free = self.number[at] == 0
            at, left = at[free], left[free]
            # of those that want one place, one has it
            self.number[at] = left + 1
            first = self.number[at] == left + 1
            at, own = at[first], left[first]
            self.low[at], self.high[at] = low[own], high[own]
            if numbers is None:
                self.number[at] = np.arange(self.count, self.count + len(own))
                self.count += len(own)
            else:
                self.number[at] = numbers[own]
            placed.append(own)
            left = left[~first]
        return np.concatenate([np.zeros(0, np.int64), *placed])

    def _numbers(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each piece, and the positions of one of each that is new."""
        eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the eight bytes from each byte on
        low = eight[starts] & MASKS[np.minimum(sizes, 8)]
        high = (eight[starts + 8] & MASKS[np.clip(sizes - 8, 0, 7)]) | (sizes.astype(np.uint64) << np.uint64(56))
        short = np.flatnonzero(sizes <= SHORT)
        low, high = low[short], high[short]
        numbers = np.zeros(len(starts), np.int64)
        numbers[short] = self.number[self._find(low, high)]
        unknown = np.flatnonzero(numbers[short] == 0)
        new = short[unknown[self._place(low[unknown], high[unknown])]]
        numbers[short[unknown]] = self.number[self._find(low[unknown], high[unknown])]
        new_long = []
        for i in np.flatnonzero(sizes > SHORT).tolist():
            key = data[starts[i] : starts[i] + sizes[i]].tobytes()
            number = self.long.get(key)
            if number is None:
                self.long[key] = number = self.count
                self.count += 1
                new_long.append(i)
            numbers[i] = number
        return numbers, np.append(new, np.array(new_long, np.int64))

    def _encode_new(self, data: np.ndarray, kinds: np.ndarray, numbers: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        """Ids of the new pieces: many are encoded as one text, which is cut where their bytes end."""
        others = np.append(0, np.cumsum(kinds != LETTER, dtype=np.int32))
        others = others[starts + sizes] - others[starts] - (data[starts] == ord(" "))
        words, rest = np.flatnonzero(others == 0), np.flatnonzero(others > 0)
        # words in the letters of their bytes, a space before each
        ends = np.cumsum(sizes[words] + 1)
        letters = np.full(ends[-1] if len(words) else 0, ord(" "), np.uint16)
        letters[_spans(ends - sizes[words], sizes[words])] = LETTERS[data[_spans(starts[words], sizes[words])]]
        ends = np.append(0, ends)[[*range(0, len(words), TOGETHER), len(words)]].tolist()
        text = letters.astype("<u2").tobytes().decode("utf-16-le")
        failed = self._cut(self.words, [text[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], numbers[words], sizes[words], sizes[words])
        # a line feed before pieces without white space keeps them apart from the last one; its id is left out
        raw = data.tobytes()
        texts = [raw[a : a + n].decode() for a, n in zip(starts[rest].tolist(), sizes[rest].tolist(), strict=True)]
        together = kinds[starts[rest] + sizes[rest] - 1] != WHITE
        joined = rest[together]
        bare = kinds[starts[joined]] != WHITE
        parts = [("\n" if b else "") + texts[i] for i, b in zip(np.flatnonzero(together).tolist(), bare.tolist(), strict=True)]
        groups = ["".join(parts[i : i + TOGETHER]) for i in range(0, len(parts), TOGETHER)]
        failed_rest = self._cut(self.tokenizer, groups, numbers[joined], sizes[joined] + bare, sizes[joined])
        alone = np.concatenate([words[failed], joined[failed_rest], rest[~together]])
        if len(alone):
            coded = self._ids(self.tokenizer, [raw[a : a + n].decode() for a, n in zip(starts[alone].tolist(), sizes[alone].tolist(), strict=True)])
            self._store(numbers[alone], np.concatenate(coded), np.array([len(x) for x in coded]))

    def _cut(self, tokenizer, groups: list[str], numbers: np.ndarray, spaced: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Stores the ids of pieces from texts of TOGETHER pieces each; positions of those of texts that can't be cut.

        A piece takes ``spaced`` bytes of a text, of which the last ``sizes`` are its own.
        """
        failed = [np.zeros(0, np.int64)]
        for k, coded in enumerate(self._ids(tokenizer, groups)):
            group = slice(k * TOGETHER, (k + 1) * TOGETHER)
            ends = np.append(0, np.cumsum(self.lengths[coded]))
            wanted = np.cumsum(spaced[group])
            last, first = np.searchsorted(ends, wanted), np.searchsorted(ends, wanted - sizes[group])
            if ends[-1] == wanted[-1] and (ends[last] == wanted).all() and (ends[first] == wanted - sizes[group]).all():
                self._store(numbers[group], coded[_spans(first, last - first)], last - first)
            else:
                failed.append(np.arange(len(numbers))[group])
        return np.concatenate(failed)

    def _ids(self, tokenizer, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, np.int32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def encode(self, texts: pa.Array | Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.count > self.remember or self.used > self.remember * IDS_EACH:
            self._forget()
        data, bounds = _bytes(texts)
        kinds = _kinds(data)
        white, length = kinds == WHITE, int(bounds[-1])
        cut = np.zeros(len(data), bool)
        cut[1:] = (white[1:] > white[:-1]) | ((kinds[1:] == SIGN) & (kinds[:-1] == LETTER))
        cut[bounds] = True
        starts = np.flatnonzero(cut[:length])
        sizes = np.diff(starts, append=length)
        numbers, new = self._numbers(data, starts, sizes)
        if len(new):
            self._encode_new(data, kinds, numbers[new], starts[new], sizes[new])
        # the end of a text stands behind its last piece
        at = np.insert(numbers, np.searchsorted(starts, bounds[1:]), 0)
        uses = np.bincount(at, minlength=self.count)
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        ids, sizes = self._gather(at)
        ends = np.append(0, np.cumsum(sizes))
        return ids, np.diff(ends[np.append(0, np.flatnonzero(at == 0) + 1)])


def worker_encoder(path: str, end: int | None = None) -> PieceEncoder:
    """The encoder of this worker. What travels by value has no globals that outlast a task, so it is kept in a module."""
    store = sys.modules.setdefault("_newsloom_encoders", types.ModuleType("_newsloom_encoders"))
    key = f"{end}:{path}"
    if not hasattr(store, key):
        # Spark has a task for each core already
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        setattr(store, key, PieceEncoder(path, end))
    return getattr(store, key)
