import json

import pytest

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from newsloom import schemas
from newsloom.operators import dedupe as dd
from newsloom.plans import pipelines as pl
from newsloom.session import shared_dir
from newsloom.sources import readers, writers


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def article(url, title="t", **more):
    return {"feed": "f", "title": title, "url": url, "published": "Tue, 21 Oct 2025 12:48:37 GMT",
            "summary": "s", "full_text": "", "scraped_at": "2025-10-21T14:13:47Z", **more}


def write(path, text):
    path.write_text(text, encoding="utf-8")


def landed(tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()
    write(folder / "a.json", json.dumps([article("u1", "één"), article("u2"), article(""), {"title": "no url"}], ensure_ascii=False))
    write(folder / "b.json", json.dumps(article("u1", "later"), indent=2))
    write(folder / "c.json", "42")
    write(folder / "d.json", "[{\"url\": \"u9\"")
    write(folder / "e.json", json.dumps([article("u3", summary=None)]))
    write(folder / "notes.txt", "not json")
    return str(folder)


def test_json_folder(spark, tmp_path):
    df = readers.read_article_json(spark, landed(tmp_path))
    assert rows(df, "url", "title") == [("", "t"), ("u1", "later"), ("u1", "één"), ("u2", "t"), ("u3", "t"), (None, "no url")]
    write(tmp_path / "landed" / "f.json", json.dumps([article("u4"), 7, "text", None, [1], article("u5") | {"extra": "kept"}]))
    mixed = readers.read_article_json(spark, f"{tmp_path}/landed/f.json").orderBy("src_pos")
    assert [(r.url, r.src_pos) for r in mixed.collect()] == [("u4", 0), ("u5", 5)]
    wider = StructType([*schemas.ARTICLE.fields, StructField("extra", StringType())])
    assert [r.extra for r in readers.read_article_json(spark, f"{tmp_path}/landed/f.json", schema=wider).orderBy("src_pos").collect()] == [None, "kept"]
    first = df.where("src_file like '%a.json'").orderBy("src_pos").select("url").collect()
    assert [r.url for r in first] == ["u1", "u2", "", None]


def test_merge(spark, tmp_path):
    extra = spark.createDataFrame([("u2", "dup"), ("u4", "new")], "url string, title string")
    merged = pl.merge_articles(spark, landed(tmp_path), extra=[extra])
    assert rows(merged, "url", "title") == [("u1", "één"), ("u2", "t"), ("u3", "t"), ("u4", "new")]
    again = pl.merge_articles(spark, extra=[merged, merged])
    assert rows(again, "url", "title") == rows(merged, "url", "title")


def test_ordered_output(spark, tmp_path):
    entries = [article(f"u{i:03}", feed=f"f{i % 3}") for i in range(100)]
    df = spark.createDataFrame(entries[::-1], schemas.ARTICLE).repartition(7)
    writers.write_json(df, f"{tmp_path}/ordered", order=["feed", "url"])
    back = readers.read_article_lines(spark, f"{tmp_path}/ordered").orderBy("src_file", "src_pos").collect()
    assert [(r.feed, r.url) for r in back] == sorted((e["feed"], e["url"]) for e in entries)


def test_archive_csv(spark, tmp_path):
    path = tmp_path / "archive.csv"
    write(path, 'date,time,title,url,full_text\n21-10-2025,09:30,"He said ""ok"", then",u1,"line one\nline two"\n05-10-2025,,b,u2,\n')
    got = readers.read_archive_csv(spark, str(path), "archive").orderBy("url").collect()
    assert [r.published for r in got] == ["Tue, 21 Oct 2025 09:30:00", "Sun, 05 Oct 2025 00:00:00"]
    assert got[0].title == 'He said "ok", then' and got[0].full_text == "line one\nline two" and got[0].feed == "archive"
    listing = tmp_path / "listing.csv"
    write(listing, "date,time,title,summary,link\n2025-10-03,10:00,a,s,https://x/1\n2025-10-04,02:30 PM,b,s,https://x/2\n2025-10-05,,c,s,https://x/3\n")
    got = readers.read_archive_csv(spark, str(listing), "listing", listing=True).orderBy("url").collect()
    assert got[0].url == "https://x/1" and got[0].summary == "s"
    assert [str(r.published_ts) for r in got] == ["2025-10-03 10:00:00", "2025-10-04 14:30:00", "2025-10-05 00:00:00"]


def test_gazetteer_tsv(spark, tmp_path):
    path = tmp_path / "NL.txt"
    full = ["1", "Sittard", "Sittard", "Zittert,Sitterd", "51.0", "5.8", "P", "PPL", "NL", "", "05", "", "", "", "37500", "", "60", "Europe/Amsterdam", "2024-01-01"]
    write(path, "\t".join(full) + "\n" + "\t".join(["2", "Short"]) + "\n" + "\t".join(["3", 'The "Quote', "", "", "1", "2", "P", "PPL", "BE"]) + "\n")
    got = {r.geonameid: r for r in readers.read_gazetteer(spark, str(path)).collect()}
    assert set(got) == {1, 3}
    assert got[1].latitude == 51.0 and got[1].admin1_code == "05" and got[3].name == 'The "Quote'


def test_coordinates_map(spark, tmp_path):
    path = tmp_path / "cache.json"
    write(path, json.dumps({"Contant": {"lat": 1.0, "lon": 2.0}, "contant": {"lat": 3, "lon": 4.5}}, indent=1))
    assert rows(readers.read_coordinates(spark, str(path)), "location", "lat", "lon") == [("Contant", 1.0, 2.0), ("contant", 3.0, 4.5)]
    assert readers.read_coordinates(spark, str(tmp_path / "absent.json")).count() == 0


def test_presets_file(spark, tmp_path):
    path = tmp_path / "presets.json"
    write(path, json.dumps({"p": {"text_filter": "x", "selected_feeds": ["a"], "date_range": ["2025-01-01", "2025-02-01"]}, "q": {}}))
    got = {r.name: r for r in readers.read_presets(spark, str(path)).collect()}
    assert got["p"].selected_feeds == ["a"] and got["p"].location_search is None and got["q"].text_filter is None


def test_enriched_json_is_flattened(spark, tmp_path):
    path = tmp_path / "enriched.json"
    write(path, json.dumps([{"title": "a", "meta": {"lang": "nl", "deep": {"x": 1}}, "locations": ["L"], "keywords": [{"word": "w", "score": 0.5}]}]))
    df = readers.read_enriched(spark, str(path))
    assert set(df.columns) == {"title", "meta.lang", "meta.deep.x", "locations", "keywords"}
    assert df.first()["meta.deep.x"] == 1 and df.first()["locations"] == ["L"]


RSS = """<?xml version="1.0"?><rss><channel><title> Nieuws </title>
<item><title>Een</title><link>https://n/1</link><guid>g1</guid><pubDate>Tue, 21 Oct 2025 12:48:37 GMT</pubDate><description>d1</description></item>
<item><title>Twee</title><guid>https://n/2</guid><description/></item>
<item><title>Pod</title><link>https://n/3.mp3</link><enclosure url="https://n/3.mp3" type="audio/mpeg"/></item>
</channel></rss>"""
ATOM = """<?xml version="1.0"?><feed><title>Atoom</title>
<entry><title>Een</title><link rel="self" href="https://n/self"/><link rel="alternate" type="text/html" href="https://n/a1"/>
<id>i1</id><updated>2025-10-21T10:00:00Z</updated><summary>s1</summary></entry></feed>"""


def test_feeds(spark, tmp_path):
    rss, atom = tmp_path / "rss.xml", tmp_path / "atom.xml"
    write(rss, RSS)
    write(atom, ATOM)
    got = readers.read_feed(spark, str(rss)).orderBy("src_pos").collect()
    assert [(r.feed, r.title, r.url) for r in got] == [
        ("Nieuws", "Een", "https://n/1"), ("Nieuws", "Twee", "https://n/2"), ("Nieuws", "Pod", "https://n/3.mp3")]
    assert got[0].published.startswith("Tue, 21 Oct") and got[0].summary == "d1" and got[1].published == ""
    nameless = tmp_path / "nameless.xml"
    write(nameless, "<feed><title> </title><entry><title>x</title><id>i</id></entry></feed>")
    assert readers.read_feed(spark, str(nameless), kind="atom").first().feed.endswith("/nameless.xml")
    row = readers.read_feed(spark, str(atom), kind="atom").first()
    assert (row.feed, row.url, row.published, row.summary) == ("Atoom", "https://n/a1", "2025-10-21T10:00:00Z", "s1")
    head = dd.head_per_feed(readers.read_feed(spark, str(rss)), 2, ["src_file", "src_pos"])
    assert [r.title for r in head.orderBy("src_pos").collect()] == ["Een", "Twee"]


def test_page_files(spark, tmp_path):
    write(tmp_path / "p.html", "<p>a\nb</p>")
    got = readers.read_page_files(spark, str(tmp_path / "*.html")).first()
    assert got.html == "<p>a\nb</p>" and got.url.endswith("p.html")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("u1", 'x "q", y\nz', "één")], "url string, title string, full_text string")
    writers.write_json(df, str(tmp_path / "json"))
    back = readers.read_article_lines(spark, str(tmp_path / "json"))
    assert rows(back, "url", "title", "full_text") == rows(df, "url", "title", "full_text")
    assert "één" in "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "json").glob("part-*"))
    writers.write_csv(df, str(tmp_path / "csv"))
    csv = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert rows(csv, "url", "title", "full_text") == rows(df, "url", "title", "full_text")
    scores = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 3.5), ("d", 0.1)], "word string, score double")
    writers.write_keyword_map(scores, str(tmp_path / "kw"), 3)
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "kw").glob("part-*"))
    assert list(json.loads(text).items()) == [("c", 3.5), ("a", 2.0), ("b", 2.0)]


def test_stage_writes_to_the_shared_folder(spark):
    df = spark.range(5).withColumn("x", F.array(F.lit("a")))
    staged = writers.stage(df, "probe")
    assert staged.count() == 5 and staged.dtypes == df.dtypes
    assert all(f.startswith(f"file:{shared_dir(spark)}/probe-") or f.startswith(f"file://{shared_dir(spark)}/probe-")
               for f in staged.inputFiles())


@pytest.mark.parametrize("lead", ["\n", "\t", " \r\n\t", "\ufeff", "\ufeff\n ", ""])
@pytest.mark.parametrize("body", ['[{"url": "u1"},\n {"url": "u2"}]', '{"url": "u1"}'])
def test_article_files_with_something_before_the_value(spark, tmp_path, lead, body):
    (tmp_path / "a.json").write_text(lead + body + "\n\t ", encoding="utf-8")
    (tmp_path / "broken.json").write_text(lead + body[:-2], encoding="utf-8")
    (tmp_path / "blank.json").write_text(lead, encoding="utf-8")
    got = readers.read_article_json(spark, str(tmp_path))
    assert sorted(r.url for r in got.collect()) == (["u1", "u2"] if body[0] == "[" else ["u1"])
