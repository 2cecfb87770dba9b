"""Chat formatting by tokens, with loss masks.

A turn reads ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a
line feed. The two marks are reserved ids behind the tokenizer's vocabulary and
exist as nothing else: role, text and line feeds are encoded on their own and
the marks spliced in between. Should a text hold the letters of a mark, a
backslash is put into it (and one more where there are some already), so the
formatted text stays unambiguous as well; reading takes it out again.

Which ids count for the loss follows from the segment lengths: ones are put
where assistant texts begin and taken away where they end, and a running sum
makes the mask.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from newsloom.llm.common import pick
from newsloom.llm.encoder import worker_encoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
MARK = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<(\\*)\\\|")
CHUNK_ROWS = 500
FORMATTED = pa.schema([
    ("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.int8())),
    ("n_chars", pa.int64()),
])
DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
    ("formatted_chars", pa.int64()),
])


def escape(text: str) -> str:
    return MARK.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role stays on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def loss_mask(lengths: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """One for every id of a learned segment, by a running sum over where they begin and end."""
    ends = np.cumsum(lengths)
    steps = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int64)
    np.add.at(steps, (ends - lengths)[learned], 1)
    np.add.at(steps, ends[learned], -1)
    return np.cumsum(steps)[:-1].astype(np.int8)


def assemble(encoder, turns: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Ids and masks of all turns in a row, ids per turn, and characters per turn."""
    start = len(encoder.lengths)
    segments, chars = [], []
    for role, text in turns:
        head, body = f"{escape_role(role)}\n", escape(text)
        segments += [head, body, "\n"]
        chars.append(len(START) + len(head) + len(body) + len(END) + 1)
    coded, sizes = encoder.encode(segments)
    n = len(turns)
    # the marks take their places between the segments: five lengths a turn
    lengths = np.ones((n, 5), np.int64)
    lengths[:, [1, 2, 4]] = sizes.reshape(n, 3)
    ends = np.cumsum(lengths).reshape(n, 5)
    ids = np.full(int(ends[-1, -1]) if n else 0, -1, np.int32)
    ids[ends[:, 0] - 1], ids[ends[:, 3] - 1] = start, start + 1
    ids[ids < 0] = coded
    learned = np.zeros((n, 5), bool)
    learned[:, 2] = [role == LEARNED for role, _ in turns]
    return ids, loss_mask(lengths.ravel(), learned.ravel()), lengths.sum(axis=1), chars


def _formatter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = worker_encoder(path)
        place = TaskContext.get().partitionId() << 40
        for rows in batches:
            for at in range(0, rows.num_rows, CHUNK_ROWS):
                part = rows.slice(at, CHUNK_ROWS)
                turns = [(r or "", t or "") for r, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                ids, mask, sizes, chars = assemble(encoder, turns)
                bounds = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(np.arange(place, place + len(turns))), part.column(1),
                        pa.ListArray.from_arrays(bounds, pa.array(ids)), pa.ListArray.from_arrays(bounds, pa.array(mask)), pa.array(chars, pa.int64()),
                    ],
                    schema=FORMATTED,
                )
                place += len(turns)

    return run


def format_chat(
    turns: DataFrame, tokenizer: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, place, turn, ids, loss_mask, n_chars``, a row per turn; ``place`` orders all turns.

    The ids of a conversation are those of its rows in order of ``place``. Turns
    are dealt out by ranges of conversation and turn, so that a conversation of
    any length is spread over tasks. Turns of one number are ordered by role and
    text; null numbers come first; null roles and texts are empty. Rows without
    a conversation form one of their own. Other columns are ignored.
    """
    return (
        pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
        .selectExpr("cast(conv_id as long) conv_id", "cast(turn as long) turn", "role", "text")
        .repartitionByRange("conv_id", "turn")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(_formatter(tokenizer), "conv_id long, place long, turn long, ids array<int>, loss_mask array<tinyint>, n_chars long")
    )


def write_chat(turns: DataFrame, path: str, tokenizer: str, **columns: str) -> None:
    format_chat(turns, tokenizer, **columns).write.mode("overwrite").option("compression", "zstd").parquet(path)


def byte_table(tokenizer) -> list[bytes]:
    """The bytes of every id of a byte-level tokenizer, then those of the two marks."""
    # printable bytes stand for themselves, the others for letters from 256 on, in order
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = tokenizer.get_vocab()
    table = [b""] * (max(vocabulary.values()) + 1)
    for token, number in vocabulary.items():
        table[number] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    return [*table, START.encode(), END.encode()]


def read_turn(ids: list[int], mask: list[int], table: list[bytes]) -> tuple[str, str, str, int]:
    """Role, text, the part of the text under the mask, and the length of the formatted turn."""
    start = len(table) - 2
    if ids[0] != start or ids[-2] != start + 1 or start in ids[1:] or start + 1 in ids[:-2]:
        raise ValueError("a turn is not framed by its marks")
    whole = b"".join(map(table.__getitem__, ids)).decode()
    role, text = whole[len(START) : -len(END) - 1].split("\n", 1)
    learned = b"".join([table[i] for i, m in zip(ids, mask, strict=True) if m]).decode()
    return unescape_role(role), unescape(text), unescape(learned), len(whole)


def _digester(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, done = byte_table(worker_encoder(path).tokenizer), []
        conv, turns, learned, counts = None, None, None, [0, 0, 0]

        def close() -> None:
            if turns is not None:
                done.append((conv, counts[0], turns.hexdigest(), counts[1], learned.hexdigest(), counts[2]))

        for rows in batches:
            # a conversation may go on from batch to batch: only its digests are held
            for c, ids, mask in zip(*(rows.column(i).to_pylist() for i in range(3)), strict=True):
                if turns is None or c != conv:
                    close()
                    conv, turns, learned, counts = c, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                role, text, seen, size = read_turn(ids, mask, table)
                turns.update(f"{role}\n{text}\n".encode())
                learned.update(seen.encode())
                counts = [counts[0] + 1, counts[1] + len(seen), counts[2] + size]
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), DIGESTS, strict=True)], schema=DIGESTS)
                done.clear()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), DIGESTS, strict=True)], schema=DIGESTS)

    return run


def chat_digests(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """What the written ids say, a row per conversation: counts and digests of turns and learned text."""
    return (
        spark.read.parquet(path).select("conv_id", "ids", "loss_mask", "place")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "place")
        .mapInArrow(_digester(tokenizer), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    )
