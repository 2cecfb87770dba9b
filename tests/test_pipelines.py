import json

import pytest

from pyspark.sql import functions as F

from newsloom.operators.filters import FilterSpec
from newsloom.operators.label_model import LabelModel
from newsloom.operators.rules import Rule
from newsloom.plans import pipelines as pl
from newsloom.streaming import ingest


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def corpus(spark):
    texts = [
        "De ondernemer in Sittard meldt fraude bij zijn bedrijf. De winkel in Sittard sluit.",
        "Het mkb in Sittard en Aken klaagt. Een bakkerij en een café in Sittard.",
        "Voetbal in Parijs: wedstrijden en muziek.",
        "Een start-up uit Visé: hack bij een bedrijf, ransomware in de winkel.",
        "",
        "Minister en partij over beleid in Sittard.",
        "Horeca en hotel in Sittard groeien. Ondernemers blij.",
        "Een bank in Aken, een supermarkt en een zaak in Aken.",
    ]
    data = [(i, f"feed{i % 2}", f"titel {i}", f"u{i}", "Tue, 21 Oct 2025 12:48:37 GMT", "", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id int, feed string, title string, url string, published string, summary string, full_text string")


def lookup(spark):
    return spark.createDataFrame([("sittard", "NL"), ("aken", "DE"), ("visé", "BE"), ("parijs", "FR")], "name_lower string, cc string")


def test_geo_resolve(spark):
    got = pl.geo_resolve(corpus(spark), lookup(spark))
    assert rows(got, "doc_id", "country") == [(0, "NL"), (1, "NL"), (3, "BE"), (5, "NL"), (6, "NL"), (7, "DE")]
    assert got.where("doc_id = 1").first().locations == ["Sittard", "Aken", "Sittard"]
    assert got.where("doc_id = 0").first().clean_geo.startswith("De ondernemer")
    everything = pl.resolve_countries(corpus(spark).withColumnRenamed("full_text", "clean_geo"), lookup(spark))
    assert everything.count() == 8
    two = everything.where("doc_id = 2").first()
    assert (two.country, two.country_score, two.country_evidence, two.locations) == ("uncertain", 0.0, [], ["Parijs"])
    four = everything.where("doc_id = 4").first()
    assert (four.country, four.country_score, four.locations) == ("uncertain", 0.0, [])


def test_thresholds_are_independent(spark):
    strict = pl.geo_resolve(corpus(spark), lookup(spark), min_conf=0.9, threshold=0.6)
    assert 1 not in [r.doc_id for r in strict.collect()]


def test_enrich(spark):
    got = pl.enrich(corpus(spark), lookup(spark), probability=0.5).cache()
    assert {r.doc_id for r in got.collect()} >= {0, 1, 3, 6, 7}
    assert 5 not in {r.doc_id for r in got.collect()}
    first = got.where("doc_id = 0").first()
    assert 0 < len(first.keywords) <= 10 and first.sme_probability > 0.5 and first.sme_label == 1
    assert "de" not in [k.word for k in first.keywords]
    none = pl.enrich(corpus(spark).where("doc_id = 5"), lookup(spark))
    assert none.count() == 0 and "keywords" in none.columns


def test_word_tokens(spark):
    marked, vocabulary = pl.word_tokens(corpus(spark), size=3)
    known = {r.word for r in vocabulary.collect()}
    assert len(known) == 3
    for r in marked.collect():
        assert set(r.tokens) <= known | {"<unk>"}


def test_keywords_keep_empty_articles(spark):
    got = {r.doc_id: r.keywords for r in pl.keywords(corpus(spark)).collect()}
    assert set(got) == set(range(8))
    titles_only = corpus(spark).withColumn("title", F.lit(""))
    assert {r.doc_id: r.keywords for r in pl.keywords(titles_only, staged=False).collect()}[4] == []
    train = corpus(spark).where("doc_id < 4")
    fitted = {w.word for r in pl.keywords(corpus(spark), fit_on=train).collect() for w in r.keywords}
    assert "horeca" not in fitted and "mkb" in fitted


def test_explore(spark):
    df = pl.enrich(corpus(spark), lookup(spark), probability=0.0)
    at = spark.createDataFrame([("Sittard", 51.0, 5.8)], "location string, lat double, lon double")
    region = spark.createDataFrame([("sittard",)], "name_lower string")
    view = pl.explore(df, FilterSpec(text_filter="sittard", date_range=("2025-10-21", "2025-10-21")), at, region)
    kept = {r.doc_id for r in view.articles.collect()}
    assert kept == {0, 1, 5, 6}
    assert rows(view.weights, "location", "weight") == [("Sittard", 6)]
    assert sum(r.mentions for r in view.titles.collect()) == 6
    assert {r.doc_id for r in view.spotlight.collect()} == kept
    assert 0 < view.keywords.count() <= 20


def test_update(spark):
    schema = "url string, published_ts timestamp, pos int"
    def frame(*data):
        return spark.createDataFrame([(u, p, i) for i, (u, p) in enumerate(data)], "url string, p string, pos int").select(
            "url", F.col("p").cast("timestamp").alias("published_ts"), "pos")
    existing = frame(("a", "2025-01-01"), ("b", "2025-01-05 12:00:00"))
    incoming = frame(("b", "2025-01-05 12:00:00"), ("c", "2025-01-05 08:00:00"), ("c", "2025-01-06"), ("old", "2025-01-03"))
    assert rows(pl.update_articles(existing, incoming, ["pos"]), "url") == [("a",), ("b",), ("c",)]
    assert rows(pl.update_articles(spark.createDataFrame([], schema), incoming, ["pos"]), "url") == [("b",), ("c",), ("old",)]


def test_pages_to_articles(spark):
    words = " ".join(["woord"] * 45)
    pages = spark.createDataFrame(
        [
            (1, "https://a.example/x", f"<title>T &amp; U</title><div>{words}.</div><p>kort</p>"),
            (2, "https://a.example/x", "<p>dup</p>"),
            (3, "https://a.example/y", "<article><p>in</p></article><p>out</p>"),
            (4, "https://a.example/z", "<p>only</p>"),
            (5, "https://a.example/z.pdf", "<p>pdf</p>"),
            (6, "", "<p>blank</p>"),
        ],
        "page_id int, url string, html string",
    )
    got = {r.page_id: r for r in pl.pages_to_articles(pages, ["page_id"]).collect()}
    assert set(got) == {1, 3, 4}
    assert got[1].full_text == words + "." and got[1].title == "T & U" and got[1].feed == "a.example"
    assert got[3].full_text == "in" and got[4].full_text == "only"


RULES = (Rule("pos", 1, (("bedrijf",),)), Rule("neg", 0, (("sport",),)))
MODEL = LabelModel((("pos", 1, 1.0), ("neg", 0, -1.0)))


def land(folder, name, *urls):
    folder.mkdir(exist_ok=True)
    data = [{"feed": "f", "title": "t", "url": u, "published": "junk" if u == "u1" else "Tue, 21 Oct 2025 12:48:37 GMT",
             "summary": "", "full_text": "een bedrijf", "scraped_at": ""} for u in urls]
    (folder / name).write_text("\n".join(json.dumps(d) for d in data))


def test_stream_matches_batch(spark, tmp_path):
    folder, table, check = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "check")
    land(folder, "a.json", "u1", "u2", "u1", "")
    run = lambda: ingest.append_to_table(
        ingest.score_stream(ingest.dedupe_stream(ingest.article_stream(spark, str(folder))), RULES, MODEL).drop("arrived_at"),
        table, check).awaitTermination()
    run()
    land(folder, "b.json", "u2", "u3")
    run()
    got = spark.read.parquet(table)
    assert rows(got, "url") == [("u1",), ("u2",), ("u3",)]
    batch = pl.merge_articles(spark, extra=[spark.read.json(str(folder))])
    assert rows(got, "url") == rows(batch, "url")
    assert {round(r.sme_probability, 6) for r in got.collect()} == {0.731059}


def test_exact_append(spark, tmp_path):
    folder, table, check = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "check")
    land(folder, "a.json", "u1", "u2", "u1", "")
    run = lambda check: ingest.exact_append(
        ingest.article_stream(spark, str(folder)), table, check, ["title"]).awaitTermination()
    run(check)
    land(folder, "b.json", "u2", "u3")
    run(check)
    assert rows(spark.read.parquet(table), "url") == [("u1",), ("u2",), ("u3",)]
    # a lost checkpoint replays everything and still adds nothing
    run(check + "2")
    assert rows(spark.read.parquet(table), "url") == [("u1",), ("u2",), ("u3",)]


def test_keyed_stream_reads_only_what_arrives(spark, tmp_path):
    folder, table, check = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "check")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ingest.ROCKSDB)
    try:
        arrived = []
        for batch in range(6):
            land(folder, f"{batch}.json", *[f"u{i}" for i in range(batch * 10, batch * 10 + 20)], "u0", "u0", "")
            run = ingest.append_to_table(ingest.keyed_stream(ingest.article_stream(spark, str(folder))), table, check)
            run.awaitTermination()
            arrived += [p["numInputRows"] for p in run.recentProgress if p["numInputRows"]]
        assert rows(spark.read.parquet(table), "url") == sorted((f"u{i}",) for i in range(70))
        # an address is one key of the state, and no batch reads more than its own file
        assert arrived == [23] * 6
        assert run.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 70
    finally:
        spark.conf.set(provider, before)
    assert spark.read.parquet(table).columns == ingest.article_stream(spark, str(folder)).columns


def test_update_lets_late_articles_in_if_asked(spark):
    schema = "pos int, url string, published_ts timestamp"
    day = lambda d: __import__("datetime").datetime(2024, 1, d)
    stored = spark.createDataFrame([(1, "a", day(5))], schema)
    arriving = spark.createDataFrame([(2, "a", day(6)), (3, "b", day(6)), (4, "late", day(1)), (5, "undated", None), (6, "b", None)], schema)
    assert rows(pl.update_articles(stored, arriving, ["pos"]), "url") == [("a",), ("b",)]
    assert rows(pl.update_articles(stored, arriving, ["pos"], late="keep"), "url") == [("a",), ("b",), ("late",), ("undated",)]
    with pytest.raises(ValueError):
        pl.update_articles(stored, arriving, ["pos"], late="some")


def test_stored_table_is_not_shuffled(spark, tmp_path):
    import uuid

    from newsloom.sources import stored

    schema = "pos int, url string, full_text string"
    table, path = f"t_{uuid.uuid4().hex}", str(tmp_path / "stored")
    held = spark.createDataFrame([(i, f"u{i}", "x" * 50) for i in range(500)] + [(1000, " ", "blank"), (1001, None, "none")], schema)
    stored.store_articles(held, table, 8, path=path)
    arriving = spark.createDataFrame([(i, f"u{i % 700}", "y") for i in range(2000, 4000)] + [(1, None, "none")], schema)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # tables of a real size
    try:
        plan = stored.not_stored(arriving, table, ["pos"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    scan = next(x for x in plan.splitlines() if "Scan parquet" in x)
    assert "Bucketed: true" in scan and "full_text" not in scan
    assert plan.count("Exchange hashpartitioning") == 1  # of what arrives
    both = stored.add_new(arriving, table, ["pos"], 8, path=path)
    assert both.count() == 700 and both.select("url").distinct().count() == 700
    assert {r.pos for r in both.where("full_text = 'y'").collect()} == {*range(2000, 2100), *range(2600, 2700)}
    assert stored.add_new(arriving, table, ["pos"], 8, path=path).count() == 700
    spark.sql(f"DROP TABLE {table}")
