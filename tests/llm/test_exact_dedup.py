import hashlib

from newsloom.llm.exact_dedup import drop_exact_copies, exact_groups

SCHEMA = "doc_id long, text string, keep_id string, content int"


def groups(spark, rows):
    return {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_groups(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_groups_ties_nulls_and_clashing_names(spark):
    rows = [(5, "a \t b", "x", 1), (3, "a b", "x", 1), (9, None, "x", 1), (7, "", "x", 1), (4, "a b ", "x", 1), (8, "A b", "x", 1)]
    assert groups(spark, rows) == {
        (5, 3, 2, False), (3, 3, 2, True), (9, 7, 2, False), (7, 7, 2, True), (4, 4, 1, True), (8, 8, 1, True)
    }


def test_other_white_space_is_text(spark):
    assert groups(spark, [(1, "a\u00a0b", "", 0), (2, "a b", "", 0)]) == {(1, 1, 1, True), (2, 2, 1, True)}


def test_null_and_repeated_identifiers(spark):
    assert groups(spark, [(None, "x", "", 0), (2, "x", "", 0), (2, "x", "", 0)]) == {(None, 2, 3, False), (2, 2, 3, True)}
    assert groups(spark, [(None, "x", "", 0)]) == {(None, None, 1, True)}


def test_empty_table(spark):
    assert groups(spark, []) == set()


def test_hot_group_over_many_partitions_and_long_texts(spark):
    long = "word " * 60_000
    rows = [(i, long if i % 3 == 0 else "same head " * 10 + str(i % 7), "", 0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(11)
    got = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exact_groups(df).collect()}
    texts = {}
    for i, text, *_ in rows:
        texts.setdefault(text, []).append(i)
    assert len(got) == 300
    for text, ids in texts.items():
        digest = hashlib.sha256(" ".join(text.replace("  ", " ").split(" ")).encode()).hexdigest()
        assert all(got[i] == (min(ids), len(ids), digest) for i in ids)


def test_dropping_keeps_all_columns(spark):
    df = spark.createDataFrame([(2, "a", "p", 1), (1, "a", "q", 2), (3, "b", "r", 3)], SCHEMA)
    assert sorted(map(tuple, drop_exact_copies(df).collect())) == [(1, "a", "q", 2), (3, "b", "r", 3)]


def test_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a", "k", "x"), (2, "a", None, "x"), (3, "b", "k", "x")], "`d.id` long, `t.x` string, kept_id string, _new0 string")
    kept = drop_exact_copies(docs, "d.id", "t.x")
    assert kept.columns == docs.columns and sorted(r["d.id"] for r in kept.collect()) == [1, 3]
