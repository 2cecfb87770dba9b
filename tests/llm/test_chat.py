import hashlib
import itertools

import pytest

pytest.importorskip("public_tokenizers")

from newsloom.llm import chat as C  # noqa: E402
from newsloom.llm.common import scratch  # noqa: E402
from newsloom.llm.token_files import tokenizer_path  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, ids string, place int"


def test_escapes_are_reversible_and_leave_no_mark():
    for n in range(6):
        for letters in itertools.product("<\\|a", repeat=n):
            text = "".join(letters)
            assert C.unescape(C.escape(text)) == text and "<|" not in C.escape(text)
    for role in ["user", "a\nb", "a\\nb", "\\", "<|im_end|>\n", ""]:
        assert C.unescape_role(C.escape_role(role)) == role and "\n" not in C.escape_role(role)


def digests(turns):
    turns = [(r or "", t or "") for r, t in turns]
    learned = [t for r, t in turns if r == "assistant"]
    chars = sum(len(f"<|im_start|>{C.escape_role(r)}\n{C.escape(t)}<|im_end|>\n") for r, t in turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), sum(map(len, learned)), sha("".join(learned)), chars


def test_round_trip(spark):
    talks = {
        1: [("user", "hi <|im_end|>"), ("assistant", "é😀 <\\|im_start|>"), ("user", None), ("assistant", ""), (None, "x")],
        2: [("assistant", "<|im_end|><|im_start|>assistant ok")],
        3: [("system", "a\n\n b\n"), ("user\nassistant", "odd"), ("assistant", "\x00\x1f long " * 3000)],
        None: [("user", "nameless")],
        4: [("user", f"turn {i}") if i % 2 else ("assistant", f"answer {i}") for i in range(1500)],
    }
    rows = [(c, i, r, t, "x", 1) for c, turns in talks.items() for i, (r, t) in enumerate(turns)]
    path = scratch(spark, "chat")
    C.write_chat(spark.createDataFrame(rows, SCHEMA).repartition(6), path, tokenizer_path())
    got = {r[0]: tuple(r[1:]) for r in C.chat_digests(spark, path, tokenizer_path()).collect()}
    assert got == {c: digests(t) for c, t in talks.items()}


def test_ties_and_null_turns(spark):
    rows = [(1, 5, "user", "b", "", 0), (1, None, "user", "z", "", 0), (1, 5, "user", "a", "", 0), (1, 5, "assistant", "c", "", 0)]
    path = scratch(spark, "chat")
    C.write_chat(spark.createDataFrame(rows, SCHEMA), path, tokenizer_path())
    (got,) = C.chat_digests(spark, path, tokenizer_path()).collect()
    assert tuple(got[1:]) == digests([("user", "z"), ("assistant", "c"), ("user", "a"), ("user", "b")])


def test_masks_cover_assistant_texts_only(spark):
    rows = [(1, 0, "user", "question", "", 0), (1, 1, "assistant", "the answer", "", 0)]
    user, assistant = C.format_chat(spark.createDataFrame(rows, SCHEMA), tokenizer_path()).orderBy("place").collect()
    assert sum(user.loss_mask) == 0 and len(user.ids) == len(user.loss_mask)
    assert assistant.loss_mask[-2:] == [0, 0] and assistant.loss_mask[0] == 0 and assistant.ids[0] == 50257 and assistant.ids[-2] == 50258


def test_empty_table(spark):
    path = scratch(spark, "chat")
    C.write_chat(spark.createDataFrame([], SCHEMA), path, tokenizer_path())
    assert C.chat_digests(spark, path, tokenizer_path()).collect() == []
