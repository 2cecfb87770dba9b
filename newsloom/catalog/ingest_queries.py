"""Record shaping, sources, de-duplication and updates."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from newsloom.catalog import inputs as src
from newsloom.catalog.registry import query
from newsloom.functions import dates as dt
from newsloom.functions import strings as st
from newsloom.operators import dedupe as dd
from newsloom.operators.filters import since
from newsloom.plans import pipelines as pl
from newsloom.session import shared_dir
from newsloom.sources import readers, stored, writers

TS = "yyyy-MM-dd HH:mm:ss"
SQL_TS = "'%Y-%m-%d %H:%M:%S'"


# --- projections ----------------------------------------------------------------


@query("project_reorder", "SELECT source, doc_id, lang FROM documents")
def project_reorder(spark, folder):
    return src.table(spark, folder, "documents").select("source", "doc_id", "lang")


@query("constant_column", "SELECT conv_id, turn, 'chat' AS feed FROM conversations")
def constant_column(spark, folder):
    return src.table(spark, folder, "conversations").select("conv_id", "turn", F.lit("chat").alias("feed"))


@query("first_nonblank", r"""
SELECT event_id, coalesce(CASE WHEN event_type <> 'view' THEN event_type END,
  CASE WHEN value > 5 THEN regexp_replace('  ' || props || ' ', '^\s+|\s+$', '', 'g') END, 'none') AS picked FROM events""")
def first_nonblank(spark, folder):
    first = F.when(F.col("event_type") != "view", F.col("event_type")).otherwise(" ")
    second = F.when(F.col("value") > 5, F.concat(F.lit("  "), "props", F.lit(" ")))
    return src.table(spark, folder, "events").select(
        "event_id", st.first_nonblank(first, second, default="none").alias("picked"))


@query("raw_text_fallback", r"""
WITH a AS (SELECT doc_id, CASE WHEN n_chars < 800 THEN '  ' ELSE text END AS full_text,
  split_part(text, chr(10), 1) AS title, CASE WHEN lang <> 'fr' THEN lang END AS summary FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(full_text, '[^\s]') THEN full_text
  ELSE regexp_replace(title || ' ' || coalesce(summary, ''), '^\s+|\s+$', '', 'g') END AS raw FROM a""")
def raw_text_fallback(spark, folder):
    docs = src.table(spark, folder, "documents").select(
        "doc_id",
        F.when(F.col("n_chars") < 800, F.lit("  ")).otherwise(F.col("text")).alias("full_text"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(F.col("lang") != "fr", F.col("lang")).alias("summary"),
    )
    return docs.select("doc_id", st.raw_text().alias("raw"))


@query("date_time_compose", """
SELECT event_id, strftime(CASE WHEN event_type = 'error' THEN date_trunc('day', ts) ELSE date_trunc('minute', ts) END,
  '%a, %d %b %Y %H:%M:%S') AS published FROM events""")
def date_time_compose(spark, folder):
    events = src.table(spark, folder, "events")
    time = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.date_format("ts", "HH:mm"))
    return events.select("event_id", dt.compose_published(F.date_format("ts", "dd-MM-yyyy"), time).alias("published"))


@query("collapse_ws", f"SELECT conv_id, turn, {src.sql_collapse('text')} AS text FROM conversations")
def collapse_ws(spark, folder):
    return src.table(spark, folder, "conversations").select("conv_id", "turn", st.collapse_ws("text").alias("text"))


@query("trim_fields", r"""
SELECT page_id, regexp_replace(chr(9) || url || ' ', '^\s+|\s+$', '', 'g') AS url,
  regexp_replace(chr(10) || html || ' ', '^\s+|\s+$', '', 'g') AS html FROM pages""")
def trim_fields(spark, folder):
    pages = src.table(spark, folder, "pages").select(
        "page_id", F.concat(F.lit("\t"), "url", F.lit(" ")).alias("url"), F.concat(F.lit("\n"), "html", F.lit(" ")).alias("html"))
    return pages.withColumns({c: st.strip(c) for c in ("url", "html")})


@query("ingest_ts", "SELECT doc_id, true AS stamped FROM documents")
def ingest_ts(spark, folder):
    """The stamp itself changes with every run; its shape does not."""
    shape = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z$"
    return src.table(spark, folder, "documents").select("doc_id", dt.ingest_ts().rlike(shape).alias("stamped"))


@query("published_parse", f"""
SELECT doc_id, strftime(CASE WHEN doc_id % 6 = 3 THEN date_trunc('day', ts) WHEN doc_id % 6 = 4 THEN date_trunc('minute', ts)
  WHEN doc_id % 6 = 5 THEN NULL ELSE ts END, {SQL_TS}) AS published_ts
FROM (SELECT doc_id, TIMESTAMP '2024-01-01' + to_hours(doc_id) AS ts FROM documents)""")
def published_parse(spark, folder):
    ts = src.publication_hour()
    kind = F.col("doc_id") % 6
    text = (
        F.when(kind == 0, F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(kind == 1, F.concat(F.date_format(ts + F.expr("interval 2 hours"), "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0200")))
        .when(kind == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 3, F.date_format(ts, "MMMM d, yyyy"))
        .when(kind == 4, F.date_format(ts, "dd-MM-yyyy HH:mm"))
        .otherwise("yesterday")
    )
    docs = src.table(spark, folder, "documents")
    return docs.select("doc_id", F.date_format(dt.published_ts(text), TS).alias("published_ts"))


@query("nested_flatten", """
SELECT event_id, CAST(props->>'k' AS BIGINT) AS "props.k", event_type AS "kind.name", value AS "kind.detail.value" FROM events""")
def nested_flatten(spark, folder):
    nested = src.table(spark, folder, "events").select(
        "event_id",
        F.from_json("props", "k bigint").alias("props"),
        F.struct(F.col("event_type").alias("name"), F.struct("value").alias("detail")).alias("kind"),
    )
    return readers.flatten(nested)


# --- union and de-duplication -----------------------------------------------------

SOURCES = """sources AS (
  SELECT 'a' AS src_file, doc_id AS src_pos, source AS feed, split_part(text, chr(10), 1) AS title, md5(text) AS url, text AS full_text FROM documents
  UNION ALL SELECT 'b', conv_id * 1000 + turn, 'chat', NULL, md5(text), text FROM conversations
  UNION ALL SELECT 'c', item_id, 'benchmark', NULL, CASE WHEN item_id < 3 THEN ' ' ELSE md5(text) END, text FROM benchmark)"""


def _sources(spark, folder):
    docs = src.table(spark, folder, "documents").select(
        F.lit("a").alias("src_file"), F.col("doc_id").alias("src_pos"), F.col("source").alias("feed"),
        F.substring_index("text", "\n", 1).alias("title"), F.md5("text").alias("url"), F.col("text").alias("full_text"))
    talk = src.table(spark, folder, "conversations").select(
        F.lit("b").alias("src_file"), (F.col("conv_id") * 1000 + F.col("turn")).alias("src_pos"), F.lit("chat").alias("feed"),
        F.md5("text").alias("url"), F.col("text").alias("full_text"))
    items = src.table(spark, folder, "benchmark").select(
        F.lit("c").alias("src_file"), F.col("item_id").alias("src_pos"), F.lit("benchmark").alias("feed"),
        F.when(F.col("item_id") < 3, F.lit(" ")).otherwise(F.md5("text")).alias("url"), F.col("text").alias("full_text"))
    return docs, talk, items


@query("union_sources", f"WITH {SOURCES} SELECT src_file, src_pos, feed, title, url FROM sources")
def union_sources(spark, folder):
    return dd.union_sources(*_sources(spark, folder)).select("src_file", "src_pos", "feed", "title", "url")


@query("union_distinct_sources", f"WITH {SOURCES} SELECT DISTINCT title, url FROM sources")
def union_distinct_sources(spark, folder):
    docs, talk, items = _sources(spark, folder)
    return dd.union_distinct(docs.select("title", "url"), talk.select("url"), items.select("url"))


@query("row_dedupe", "SELECT DISTINCT role, turn, text FROM conversations")
def row_dedupe(spark, folder):
    talk = src.table(spark, folder, "conversations").select("role", "turn", "text")
    return dd.union_distinct(talk, talk)


@query("merge_articles", f"""
WITH {SOURCES} SELECT feed, title, url, full_text FROM sources WHERE trim(url) <> ''
QUALIFY row_number() OVER (PARTITION BY url ORDER BY src_file, src_pos) = 1""")
def merge_articles(spark, folder):
    return pl.merge_articles(spark, extra=_sources(spark, folder)).select("feed", "title", "url", "full_text")


@query("url_dedupe_first", f"""
WITH {src.ARTICLES} SELECT doc_id, feed, url FROM articles
QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1""")
def url_dedupe_first(spark, folder):
    return dd.url_dedupe(src.articles(spark, folder).select("doc_id", "feed", "url"), ["doc_id"])


# the first line repeats within documents that are near copies
@query("keep_first", f"""
WITH {src.ARTICLES} SELECT title, doc_id FROM articles QUALIFY row_number() OVER (PARTITION BY title ORDER BY doc_id DESC) = 1""")
def keep_first(spark, folder):
    return dd.keep_first(src.articles(spark, folder).select("title", "doc_id"), ["title"], [F.desc("doc_id")])


FEED_EVENTS = """feed_events AS (SELECT event_id, event_type AS feed,
  CASE WHEN value < 5 THEN '' ELSE user_id::VARCHAR END AS url FROM events)"""


def _feed_events(spark, folder):
    link = F.when(F.col("value") < 5, F.lit("")).otherwise(F.col("user_id").cast("string"))
    return src.table(spark, folder, "events").select("event_id", F.col("event_type").alias("feed"), link.alias("url"))


@query("feed_dedupe", f"""
WITH {FEED_EVENTS} SELECT event_id, feed, url FROM feed_events WHERE url = '' UNION ALL
(SELECT event_id, feed, url FROM feed_events WHERE url <> ''
 QUALIFY row_number() OVER (PARTITION BY feed, url ORDER BY event_id) = 1)""")
def feed_dedupe(spark, folder):
    return dd.feed_dedupe(_feed_events(spark, folder), ["event_id"], blank="keep")


@query("feed_dedupe_drop_blank", f"""
WITH {FEED_EVENTS} SELECT event_id, feed, url FROM feed_events WHERE url <> ''
QUALIFY row_number() OVER (PARTITION BY feed, url ORDER BY event_id) = 1""")
def feed_dedupe_drop_blank(spark, folder):
    return dd.feed_dedupe(_feed_events(spark, folder), ["event_id"], blank="drop")


@query("feed_head_n", """
SELECT event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 25""")
def feed_head_n(spark, folder):
    events = src.table(spark, folder, "events").select("event_id", "event_type", "ts")
    return dd.head_per_feed(events, 25, ["ts", "event_id"], "event_type").select("event_id", "event_type")


@query("head_feeds", """
SELECT event_id, event_type FROM events WHERE event_type IN (SELECT DISTINCT event_type FROM events ORDER BY 1 LIMIT 2)""")
def head_feeds(spark, folder):
    return dd.head_feeds(src.table(spark, folder, "events").select("event_id", "event_type"), 2, "event_type")


@query("date_cutoff", f"SELECT event_id, strftime(ts, {SQL_TS}) AS at FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def date_cutoff(spark, folder):
    recent = src.table(spark, folder, "events").where(since("ts", "2024-01-15"))
    return recent.select("event_id", F.date_format("ts", TS).alias("at"))


@query("new_articles_anti", f"""
WITH {src.ARTICLES}, stored AS (SELECT md5(text) AS url FROM documents WHERE lang = 'en')
SELECT doc_id, url FROM articles WHERE url NOT IN (SELECT url FROM stored)
QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1""")
def new_articles_anti(spark, folder):
    stored = src.table(spark, folder, "documents").where("lang = 'en'").select(F.md5("text").alias("url"))
    return dd.new_only(src.articles(spark, folder).select("doc_id", "url"), stored, ["doc_id"])


# Pages stand for the incoming articles: each has a link of its own and, by its number, that of a document.
ARRIVING = """arriving AS (SELECT page_id AS doc_id, url, TIMESTAMP '2024-01-01' + to_hours(page_id * 5) AS published_ts FROM pages
  UNION ALL SELECT page_id, 'https://news.example/' || (page_id * 2), TIMESTAMP '2024-01-01' + to_hours(page_id * 5) FROM pages),
stored AS (SELECT doc_id, 'https://news.example/' || doc_id AS url, TIMESTAMP '2024-01-01' + to_hours(doc_id) AS published_ts FROM documents)"""


def _stored_and_arriving(spark, folder):
    docs, pages = src.table(spark, folder, "documents"), src.table(spark, folder, "pages")
    link = F.lit("https://news.example/")
    held = docs.select("doc_id", F.concat(link, F.col("doc_id").cast("string")).alias("url"), src.publication_hour().alias("published_ts"))
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 5 * 3600).alias("published_ts")
    own = pages.select(F.col("page_id").alias("doc_id"), "url", at)
    other = pages.select(F.col("page_id").alias("doc_id"), F.concat(link, (F.col("page_id") * 2).cast("string")).alias("url"), at)
    return held, own.unionByName(other)


def _update_sql(kept: str) -> str:
    return f"""
WITH {ARRIVING},
fresh AS (SELECT * FROM arriving WHERE {kept} AND url NOT IN (SELECT url FROM stored))
SELECT doc_id, url FROM stored UNION ALL
(SELECT doc_id, url FROM fresh QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1)"""


@query("update_articles", _update_sql("published_ts >= (SELECT date_trunc('day', max(published_ts)) FROM stored)"))
def update_articles(spark, folder):
    """All documents are stored, all pages arrive; what is older than the newest stored day stays out."""
    docs, arriving = _stored_and_arriving(spark, folder)
    return pl.update_articles(docs, arriving, ["doc_id"]).select("doc_id", "url")


@query("update_articles_late", _update_sql("true"))
def update_articles_late(spark, folder):
    """The same with late arrivals let in."""
    docs, arriving = _stored_and_arriving(spark, folder)
    return pl.update_articles(docs, arriving, ["doc_id"], late="keep").select("doc_id", "url")


@query("update_stored_table", _update_sql("true"))
def update_stored_table(spark, folder):
    """The same into a table in buckets by address, which is never shuffled."""
    docs, arriving = _stored_and_arriving(spark, folder)
    table = f"stored_{uuid.uuid4().hex}"
    path = _scratch(spark, "stored")
    stored.store_articles(docs, table, path=path)
    return stored.add_new(arriving, table, ["doc_id"], path=path).select("doc_id", "url")


# --- files ------------------------------------------------------------------------


def _scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _article_rows(spark, folder):
    docs = src.table(spark, folder, "documents")
    return docs.select(
        F.col("source").alias("feed"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.date_format(src.publication_hour(), dt.PUBLISHED_LAYOUT).alias("published"),
        F.lit(None).cast("string").alias("summary"),
        F.col("text").alias("full_text"),
        F.lit("2024-01-01T00:00:00Z").alias("scraped_at"),
    )


ROUNDTRIP = """
SELECT source AS feed, split_part(text, chr(10), 1) AS title, 'https://news.example/' || doc_id AS url, {published} AS published, text AS full_text
FROM documents"""


@query("json_roundtrip", ROUNDTRIP.format(published="strftime(TIMESTAMP '2024-01-01' + to_hours(doc_id), '%a, %d %b %Y %H:%M:%S')"))
def json_roundtrip(spark, folder):
    path = _scratch(spark, "json")
    writers.write_json(_article_rows(spark, folder), path)
    back = readers.read_article_lines(spark, path)
    return back.select("feed", "title", "url", "published", "full_text")


@query("csv_roundtrip", ROUNDTRIP.replace("source AS feed", "'archive' AS feed").format(
    published="strftime(TIMESTAMP '2024-01-01' + to_hours(doc_id), '%a, %d %b %Y %H:%M:%S')"))
def csv_roundtrip(spark, folder):
    """Articles to the archive layout and back, line breaks and quotes included."""
    path = _scratch(spark, "csv")
    rows = _article_rows(spark, folder).withColumn("ts", dt.published_ts("published"))
    day, time = F.date_format("ts", "dd-MM-yyyy"), F.date_format("ts", "HH:mm")
    writers.write_csv(rows.select(day.alias("date"), time.alias("time"), "title", "url", "full_text"), path)
    return readers.read_archive_csv(spark, path, "archive").select("feed", "title", "url", "published", "full_text")


@query("listing_csv_roundtrip", """
SELECT 'listing' AS feed, 'https://news.example/' || doc_id AS url,
  strftime(TIMESTAMP '2024-01-01' + to_hours(doc_id), '%Y-%m-%d %H:%M') AS at FROM documents""")
def listing_csv_roundtrip(spark, folder):
    """Listing rows with a time of twelve hours, and back."""
    path = _scratch(spark, "listing")
    rows = _article_rows(spark, folder).withColumn("ts", dt.published_ts("published"))
    day, time = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "hh:mm a")
    writers.write_csv(
        rows.select(day.alias("date"), time.alias("time"), "title", F.lit("").alias("summary"), F.col("url").alias("link")), path)
    back = readers.read_archive_csv(spark, path, "listing", listing=True)
    return back.select("feed", "url", F.date_format("published_ts", "yyyy-MM-dd HH:mm").alias("at"))


@query("coordinates_map", """
SELECT source AS location, count(*)::DOUBLE AS lat, max(n_chars)::DOUBLE AS lon FROM documents GROUP BY source""")
def coordinates_map(spark, folder):
    """Sources stand for places: one JSON object of them all, read as a table."""
    path = _scratch(spark, "coordinates")
    at = F.struct(F.count(F.lit(1)).cast("double").alias("lat"), F.max("n_chars").cast("double").alias("lon"))
    places = src.table(spark, folder, "documents").groupBy("source").agg(at.alias("at"))
    # one entry per source
    entries = F.map_from_entries(F.collect_list(F.struct("source", "at")))
    places.agg(F.to_json(entries).alias("value")).write.text(path)
    return readers.read_coordinates(spark, path)


@query("keyword_map_roundtrip", """
SELECT source AS word, round(sum(n_chars) / 1000.0, 6)::DOUBLE AS score FROM documents GROUP BY source
ORDER BY score DESC, word LIMIT 20""")
def keyword_map_roundtrip(spark, folder):
    path = _scratch(spark, "keywords")
    docs = src.table(spark, folder, "documents")
    scores = docs.groupBy(F.col("source").alias("word")).agg((F.sum("n_chars") / 1000.0).cast("double").alias("score"))
    writers.write_keyword_map(scores, path)
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", "map<string,double>")).alias("word", "score"))
    return entries.select("word", F.round("score", 6).alias("score"))


def _json_arrays(spark, folder, path: str) -> None:
    """The documents as files of one array each, with what may stand around an array; of one address the first source leads."""
    writers.write_json_arrays(_article_rows(spark, folder), path, "url", order=["feed", "url"])


@query("json_dir_scan", ROUNDTRIP.format(published="strftime(TIMESTAMP '2024-01-01' + to_hours(doc_id), '%a, %d %b %Y %H:%M:%S')"))
def json_dir_scan(spark, folder):
    """A folder of JSON arrays that begin with line feeds, tabs or a byte order mark."""
    path = _scratch(spark, "arrays")
    _json_arrays(spark, folder, path)
    back = readers.read_article_json(spark, path, names="*.txt")
    return back.select("feed", "title", "url", "published", "full_text")


@query("merge_files", """
WITH files AS (SELECT 'https://news.example/' || doc_id AS url, source AS feed FROM documents),
pages AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://news.example/' || page_id ELSE url END AS url FROM pages)
SELECT url, feed FROM files UNION ALL
(SELECT url, 'page' AS feed FROM pages WHERE url NOT IN (SELECT url FROM files)
 QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1)""")
def merge_files(spark, folder):
    """Article files and a further source that repeats every second address."""
    path = _scratch(spark, "merge")
    _json_arrays(spark, folder, path)
    own = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("https://news.example/"), F.col("page_id").cast("string"))).otherwise(F.col("url"))
    pages = src.table(spark, folder, "pages").select(own.alias("url"), F.lit("page").alias("feed"))
    return pl.merge_articles(spark, path, extra=[pages], names="*.txt").select("url", "feed")


@query("feed_order", """
SELECT doc_id, row_number() OVER (ORDER BY source, doc_id DESC) AS place FROM documents""")
def feed_order(spark, folder):
    """Articles written in the order of their feeds, and the place in the files they are read back from."""
    path = _scratch(spark, "order")
    docs = src.table(spark, folder, "documents").select("source", (-F.col("doc_id")).alias("back"), F.col("doc_id").cast("string").alias("url"))
    writers.write_json(docs, path, order=["source", "back"])
    lines = readers.read_article_lines(spark, path)
    # rows of a file in their order, files by name: small counts per file, as for any place in a folder
    files = lines.groupBy("src_file").agg(F.count("*").alias("n"))
    before = files.alias("a").join(files.alias("b"), F.col("b.src_file") < F.col("a.src_file"), "left").groupBy(
        F.col("a.src_file").alias("src_file")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("src_file").orderBy("src_pos"))
    placed = lines.withColumn("own", own).join(before, "src_file")
    return placed.select(F.col("url").cast("long").alias("doc_id"), (F.col("own") + F.col("before")).alias("place"))


def _feed_lines(spark, folder):
    """Lines of one RSS channel per source: a head, an item per document, an end."""
    docs = src.table(spark, folder, "documents")
    number = F.col("doc_id").cast("string")
    at = F.date_format(src.publication_hour(), dt.PUBLISHED_LAYOUT)
    item = F.concat(
        F.lit("<item><title> Caf\u00e9 &amp; &lt;News&gt; "), number, F.lit("</title><link>https://news.example/"), number,
        F.lit("</link><pubDate>"), at, F.lit("</pubDate><description>"), F.col("n_chars").cast("string"), F.lit(" characters</description></item>"))
    items = docs.select("source", F.lit(1).alias("kind"), "doc_id", item.alias("value"))
    sources = docs.select("source").distinct()
    head = F.concat(F.lit("<rss><channel><title> The "), "source", F.lit(" </title>"))
    heads = sources.select("source", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("doc_id"), head.alias("value"))
    ends = sources.select("source", F.lit(2).alias("kind"), F.lit(-1).cast("long").alias("doc_id"), F.lit("</channel></rss>").alias("value"))
    return heads.unionByName(items).unionByName(ends)


@query("feed_scan", """
SELECT 'The ' || source AS feed, 'Café & <News> ' || doc_id AS title, 'https://news.example/' || doc_id AS url,
  strftime(TIMESTAMP '2024-01-01' + to_hours(doc_id), '%a, %d %b %Y %H:%M:%S') AS published, n_chars || ' characters' AS summary,
  row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS src_pos FROM documents""")
def feed_scan(spark, folder):
    """Channels written as XML, read as entries."""
    path = _scratch(spark, "feeds")
    lines = _feed_lines(spark, folder).repartition("source").sortWithinPartitions("source", "kind", "doc_id")
    lines.select("source", "value").write.partitionBy("source").text(path)  # a file holds one channel
    entries = readers.read_feed(spark, f"{path}/*")
    return entries.select("feed", "title", "url", "published", "summary", F.col("src_pos").cast("long").alias("src_pos"))
