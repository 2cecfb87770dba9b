import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from newsloom.llm.common import scratch  # noqa: E402
from newsloom.llm.encoder import PieceEncoder  # noqa: E402
from newsloom.llm.token_files import ids_crc32, read_tokens, tokenizer_path, write_tokens  # noqa: E402

SCHEMA = "doc_id long, text string, ids string, start int"
HARD = [
    "", " ", "\n", "a  b", "a\n\nb", "\n\n\nx y\n", " lead", "trail ", "tab\tx", "a\x1cb !\x1c c", "a\xa0b c　 d", "don't we'll 'd",
    "x<|endoftext|> <|endoftext|>", "é" * 5 + " ñ", "a \n b", "1 22  333\r\n\r\n4", "😀 😀😀\n😀", "a\x85b", "word.\n\n\n\nNext", "!!!\n?", "it's. it'. 'll, x###",
]


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("remember", [500_000, 40])
def test_pieces_give_the_ids_of_whole_texts(library, remember):
    rng = random.Random(1)
    texts = HARD + ["".join(rng.choice(" \n\t\r\x1c ab1é'!.,<|>s😀") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    encoder = PieceEncoder(tokenizer_path(), 0, remember)
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        ids, sizes = encoder.encode(part)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [[*x, 0] for x in library(part)]


def test_files_hold_the_stream_in_order(spark, library):
    texts = [*HARD, None, "long text " * 20_000]
    rows = [(3 * i, t, "x", 1) for i, t in enumerate(texts)] + [(3, "second row of three", "x", 1), (None, "nameless", "x", 1)]
    random.Random(4).shuffle(rows)
    path = scratch(spark, "tokens")
    write_tokens(spark.createDataFrame(rows, SCHEMA).repartition(5), path, tokenizer_path())
    got = read_tokens(spark, path).withColumn("crc", ids_crc32("ids")).orderBy("start").collect()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for (doc, *_), coded, row in zip(rows, library([t or "" for _, t, *_ in rows]), got, strict=True):
        ids = np.array([*coded, 0], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids, row.crc) == (doc, start, len(ids), ids.tolist(), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_file_format(spark):
    path = scratch(spark, "tokens")
    write_tokens(spark.createDataFrame([(i, "some words of text " * 9, "", 1) for i in range(300)], SCHEMA), path, tokenizer_path())
    files = [r[0].removeprefix("file:") for r in spark.read.parquet(f"{path}/data").selectExpr("_metadata.file_path").distinct().collect()]
    group = pq.ParquetFile(files[0]).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    assert columns["doc_id"].encodings == ("DELTA_BINARY_PACKED",)
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
    plan = read_tokens(spark, path).where("doc_id = 7").select("n_tokens")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,7)" in plan and "ids" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_empty_table(spark):
    path = scratch(spark, "tokens")
    write_tokens(spark.createDataFrame([], SCHEMA), path, tokenizer_path())
    assert read_tokens(spark, path).collect() == []
