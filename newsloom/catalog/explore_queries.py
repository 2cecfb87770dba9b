"""Filters, place aggregates, spotlight and the streamed ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from newsloom.catalog import inputs as src
from newsloom.catalog.place_queries import RESOLVED
from newsloom.catalog.registry import query
from newsloom.catalog.rule_queries import LOG_ODDS, MODEL
from newsloom.catalog.text_queries import FEATURES, TERMS
from newsloom.operators import dedupe as dd
from newsloom.operators import explore as ex
from newsloom.operators import filters as fl
from newsloom.operators import label_model as lm
from newsloom.operators import rules as ru
from newsloom.plans import pipelines as pl
from newsloom.session import shared_dir
from newsloom.streaming import ingest

DATE = "'%Y-%m-%d'"


@query("text_search", f"""
WITH {src.ARTICLES} SELECT doc_id FROM articles WHERE contains(lower(feed), 'the of')
  OR contains(lower(title), 'the of') OR contains(lower(url), 'the of') OR contains(lower(full_text), 'the of')""")
def text_search(spark, folder):
    df = src.articles(spark, folder)
    return df.where(fl.text_matches(df.schema, "The OF")).select("doc_id")


@query("text_search_pattern", f"""
WITH {src.LOCATED} SELECT doc_id FROM located WHERE regexp_matches(feed, '(?i)und?\\s+der') OR regexp_matches(title, '(?i)und?\\s+der')
  OR regexp_matches(url, '(?i)und?\\s+der') OR regexp_matches(full_text, '(?i)und?\\s+der')
  OR regexp_matches(to_json(locations)::VARCHAR, '(?i)und?\\s+der')""")
def text_search_pattern(spark, folder):
    df = src.located(spark, folder)
    return df.where(fl.text_matches(df.schema, r"und?\s+der", literal=False)).select("doc_id")


@query("feed_in", "SELECT doc_id, source AS feed FROM documents WHERE source IN ('src1', 'src3', 'none')")
def feed_in(spark, folder):
    return src.articles(spark, folder).where(fl.feed_in(["src1", "src3", "none"])).select("doc_id", "feed")


@query("location_tag_filter", f"""
WITH {src.LOCATED} SELECT doc_id FROM located
WHERE len(list_filter(locations, lambda l: contains(lower(l), 'nicht') OR contains(lower(l), 'las'))) > 0""")
def location_tag_filter(spark, folder):
    return src.located(spark, folder).where(fl.location_tags(" Nicht, ,las ")).select("doc_id")


@query("date_range_filter", f"""
WITH {src.ARTICLES} SELECT doc_id FROM articles WHERE published_ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def date_range_filter(spark, folder):
    df = src.articles(spark, folder)
    return df.where(fl.date_between("published_ts", "2024-01-05", "2024-01-20")).select("doc_id")


@query("clamp_range", f"""
WITH b AS (SELECT min(ts)::DATE AS lo, max(ts)::DATE AS hi FROM events),
r(case_name, s, e) AS (VALUES ('wide', DATE '2000-01-01', DATE '2100-01-01'), ('inside', DATE '2024-01-05', DATE '2024-01-09'),
  ('inverted', DATE '2024-01-09', DATE '2024-01-05'), ('unreadable', NULL, DATE '2024-01-05'), ('after', DATE '2090-01-01', DATE '2091-01-01')),
c AS (SELECT case_name, lo, hi, s IS NULL OR e IS NULL OR greatest(least(s, hi), lo) > greatest(least(e, hi), lo) AS full_range,
  greatest(least(s, hi), lo) AS cs, greatest(least(e, hi), lo) AS ce FROM r, b)
SELECT case_name, strftime(CASE WHEN full_range THEN lo ELSE cs END, {DATE}) AS start_d,
  strftime(CASE WHEN full_range THEN hi ELSE ce END, {DATE}) AS end_d FROM c""")
def clamp_range(spark, folder):
    bounds = fl.date_bounds(src.table(spark, folder, "events"), "ts")
    cases = {"wide": ("2000-01-01", "2100-01-01"), "inside": ("2024-01-05", "2024-01-09"),
             "inverted": ("2024-01-09", "2024-01-05"), "unreadable": ("soon", "2024-01-05"), "after": ("2090-01-01", "2091-01-01")}
    frames = [fl.clamp_range(bounds, *span).withColumn("case_name", F.lit(name)) for name, span in cases.items()]
    return dd.union_sources(*frames).select(
        "case_name", F.date_format("start_d", "yyyy-MM-dd").alias("start_d"), F.date_format("end_d", "yyyy-MM-dd").alias("end_d"))


PRESETS = {
    "all": fl.FilterSpec(),
    "german": fl.FilterSpec(text_filter="und der"),
    "early": fl.FilterSpec(date_range=("2024-01-01", "2024-01-10")),
    "inverted": fl.FilterSpec(date_range=("2024-01-10", "2024-01-01")),
    "later": fl.FilterSpec(date_range=("2090-01-01", "2091-01-01")),
    "unreadable": fl.FilterSpec(date_range=("soon", "2024-01-05")),
    "open_end": fl.FilterSpec(date_range=("2024-01-05", "2091-01-01"), text_filter="und der"),
    "tagged": fl.FilterSpec(location_search="nicht, le", selected_feeds=("src1", "src2", "src3", "src4")),
}
PRESET_SQL = {
    "all": "true",
    "german": "contains(lower(full_text), 'und der') OR contains(lower(title), 'und der')",
    "early": "published_ts::DATE BETWEEN DATE '2024-01-01' AND DATE '2024-01-10'",
    "inverted": "true",
    "later": "published_ts::DATE = (SELECT max(published_ts)::DATE FROM located)",
    "unreadable": "true",
    "open_end": "published_ts::DATE >= DATE '2024-01-05' AND (contains(lower(full_text), 'und der') OR contains(lower(title), 'und der'))",
    "tagged": "feed IN ('src1', 'src2', 'src3', 'src4') AND "
              "len(list_filter(locations, lambda l: contains(lower(l), 'nicht') OR contains(lower(l), 'le'))) > 0",
}


@query("preset_counts", f"WITH {src.LOCATED} " + " UNION ALL ".join(
    f"SELECT '{name}' AS preset, count(*) AS n FROM located WHERE {cond}" for name, cond in PRESET_SQL.items()))
def preset_counts(spark, folder):
    tagged = fl.tag_presets(src.located(spark, folder), PRESETS)
    return tagged.groupBy("preset").agg(F.count(F.lit(1)).alias("n"))


@query("bounds_and_feeds", f"""
SELECT strftime(min(ts), {DATE}) AS min_d, strftime(max(ts), {DATE}) AS max_d, count(DISTINCT event_type) AS feeds FROM events""")
def bounds_and_feeds(spark, folder):
    events = src.table(spark, folder, "events")
    feeds = fl.feed_options(events, "event_type").agg(F.count(F.lit(1)).alias("feeds"))
    return fl.date_bounds(events, "ts").select(
        F.date_format("min_d", "yyyy-MM-dd").alias("min_d"), F.date_format("max_d", "yyyy-MM-dd").alias("max_d"),
        feeds.scalar().alias("feeds"))


@query("feed_options", "SELECT DISTINCT source AS feed FROM documents WHERE source IS NOT NULL")
def feed_options(spark, folder):
    return fl.feed_options(src.articles(spark, folder))


@query("keep_ratio", """
SELECT 'english' AS stage, count(*) FILTER (lang = 'en') AS kept, count(*) AS total,
  round(count(*) FILTER (lang = 'en') / count(*)::DOUBLE, 9) AS ratio FROM documents
UNION ALL SELECT 'long', count(*) FILTER (n_chars > 2000), count(*), round(count(*) FILTER (n_chars > 2000) / count(*)::DOUBLE, 9) FROM documents""")
def keep_ratio(spark, folder):
    stages = {"english": F.col("lang") == "en", "long": F.col("n_chars") > 2000}
    kept = fl.keep_ratio(src.table(spark, folder, "documents"), stages)
    return kept.withColumn("ratio", F.round("ratio", 9))


PLACED = f"""{src.LOCATED}, {src.PLACES_SQL},
each AS (SELECT doc_id, title, unnest(locations) AS location FROM located),
placed AS (SELECT e.doc_id, coalesce(e.title, 'Untitled Article') AS title, p.* FROM each e JOIN places p ON e.location = p.location)"""


@query("geocode_join", f"WITH {PLACED} SELECT location, lat, lon, title FROM placed")
def geocode_join(spark, folder):
    return ex.located_mentions(src.located(spark, folder), src.coordinates(spark))


@query("location_weights", f"WITH {PLACED} SELECT location, lat, lon, count(*) AS weight FROM placed GROUP BY location, lat, lon")
def location_weights(spark, folder):
    return ex.location_weights(ex.located_mentions(src.located(spark, folder), src.coordinates(spark)))


@query("location_titles", f"""
WITH {PLACED} SELECT location, lat, lon, title, count(*) AS mentions FROM placed GROUP BY location, lat, lon, title""")
def location_titles(spark, folder):
    return ex.location_titles(ex.located_mentions(src.located(spark, folder), src.coordinates(spark)))


@query("region_semi", f"""
WITH {src.LOCATED}, {src.REGION_SQL}
SELECT doc_id FROM located WHERE EXISTS (SELECT 1 FROM (SELECT unnest(locations) AS l) u JOIN region_names r ON lower(u.l) = r.name_lower)""")
def region_semi(spark, folder):
    return ex.region_semi(src.located(spark, folder), src.region(spark)).select("doc_id")


def _scored(spark, folder):
    located = src.located(spark, folder)
    names = [r.name for r in ru.active_rules(src.WORD_RULES)]
    return lm.label(ru.apply_rules(located, src.WORD_RULES, "full_text"), MODEL).drop(*names)


SCORED = f"""{src.LOCATED}, {src.REGION_SQL}, {src.votes_sql()},
scored AS (SELECT l.*, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({LOG_ODDS}))) AS p FROM located l JOIN votes v ON l.doc_id = v.doc_id)"""


@query("top5_prob", f"""
WITH {SCORED} SELECT doc_id, round(p, 9) AS sme_probability FROM scored ORDER BY p DESC, doc_id LIMIT 5""")
def top5_prob(spark, folder):
    best = ex.top_probability(_scored(spark, folder))
    return best.select("doc_id", F.round("sme_probability", 9).alias("sme_probability"))


SPOTLIGHT = """best AS (SELECT doc_id FROM {rows} ORDER BY p DESC, doc_id LIMIT 5),
flags AS (SELECT doc_id, len(list_filter(locations, lambda l: lower(l) IN ('der', 'nicht', 'le', 'un'))) > 0 AS r,
  doc_id IN (SELECT doc_id FROM best) AS t FROM {rows})
SELECT doc_id, CASE WHEN r AND t THEN 'region+probability' WHEN r THEN 'region' ELSE 'probability' END AS reason FROM flags WHERE r OR t"""


@query("spotlight", f"WITH {SCORED}, " + SPOTLIGHT.format(rows="scored"))
def spotlight(spark, folder):
    return ex.spotlight(_scored(spark, folder), src.region(spark)).select("doc_id", "reason")


SPEC = fl.FilterSpec(text_filter="the", location_search="th, le", date_range=("2023-01-01", "2024-02-01"))
CHOSEN = f"""{SCORED},
chosen AS (SELECT * FROM scored WHERE (contains(lower(full_text), 'the') OR contains(lower(title), 'the') OR contains(lower(feed), 'the'))
  AND len(list_filter(locations, lambda l: contains(lower(l), 'th') OR contains(lower(l), 'le'))) > 0
  AND published_ts::DATE <= DATE '2024-02-01')"""


@query("explore_articles", f"WITH {CHOSEN} SELECT doc_id FROM chosen")
def explore_articles(spark, folder):
    return fl.apply_filters(_scored(spark, folder), SPEC).select("doc_id")


@query("explore_spotlight", f"WITH {CHOSEN}, " + SPOTLIGHT.format(rows="chosen"))
def explore_spotlight(spark, folder):
    view = _explored(spark, folder)
    return view.spotlight.select("doc_id", "reason")


@query("explore_map", f"""
WITH {CHOSEN}, {src.PLACES_SQL}, each AS (SELECT unnest(locations) AS location FROM chosen)
SELECT p.location, p.lat, p.lon, count(*) AS weight FROM each e JOIN places p ON e.location = p.location GROUP BY ALL""")
def explore_map(spark, folder):
    return _explored(spark, folder).weights


@query("explore_keywords", "WITH " + CHOSEN + ", " + TERMS.replace(
    "leaders AS (SELECT term AS word, sum(score) AS score FROM top10 GROUP BY term)",
    "leaders AS (SELECT term AS word, sum(score) AS score FROM top10 WHERE doc_id IN (SELECT doc_id FROM chosen) GROUP BY term)")
    + " SELECT word, round(score, 6) AS score FROM leaders ORDER BY round(score, 9) DESC, word LIMIT 20")
def explore_keywords(spark, folder):
    return _explored(spark, folder, with_keywords=True).keywords.select("word", F.round("score", 6).alias("score"))


def _explored(spark, folder, with_keywords: bool = False):
    df = _scored(spark, folder)
    if with_keywords:
        df = df.join(pl.keywords(src.articles(spark, folder), max_features=FEATURES), "doc_id")
    else:
        df = df.withColumn("keywords", F.array().cast("array<struct<word:string,score:double>>"))
    return pl.explore(df, SPEC, src.coordinates(spark), src.region(spark))


@query("enrich", f"""
WITH RECURSIVE {RESOLVED}, {src.votes_sql()},
probable AS (SELECT r.doc_id, r.country, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({LOG_ODDS}))) AS p FROM resolved r JOIN votes v ON r.doc_id = v.doc_id),
selected AS (SELECT * FROM probable WHERE p > 0.6),
{TERMS.replace("FROM documents)", "FROM documents WHERE doc_id IN (SELECT doc_id FROM selected))", 1)}
SELECT s.doc_id, s.country, round(s.p, 9) AS sme_probability,
  coalesce(string_agg(t.term || ':' || printf('%.6f', t.score), ' ' ORDER BY t.rn), '') AS keywords
FROM selected s LEFT JOIN top10 t ON s.doc_id = t.doc_id GROUP BY ALL""")
def enrich(spark, folder):
    """Country filter, label, probability filter and keywords in one job, with fixed weights."""
    rows = pl.enrich(src.articles(spark, folder), src.lexicon(spark), src.WORD_RULES, model=MODEL)
    shown = F.transform("keywords", lambda k: F.format_string("%s:%.6f", k["word"], k["score"]))
    return rows.select("doc_id", "country", F.round("sme_probability", 9).alias("sme_probability"),
                       F.array_join(shown, " ").alias("keywords"))


# --- streams ----------------------------------------------------------------------


def _document_stream(spark, folder):
    """The documents as a stream, from one file or from a folder of files."""
    schema = src.table(spark, folder, "documents").schema
    # a stream takes a path for a folder unless it is a pattern; this one matches the table alone
    docs = spark.readStream.schema(schema).parquet(f"{folder}/{{documents.parquet}}")
    return docs.select("doc_id", F.col("source").alias("feed"), F.md5("text").alias("url"),
                       F.lit("").alias("title"), F.lit("").alias("summary"), F.col("text").alias("full_text"))


@query("stream_ingest", f"""
WITH {SCORED}, u AS (SELECT md5(text) AS url, min(doc_id) AS doc_id FROM documents GROUP BY 1)
SELECT u.url, round(s.p, 9) AS sme_probability FROM u JOIN scored s ON s.doc_id = u.doc_id""")
def stream_ingest(spark, folder):
    """Each text once, scored with a frozen model, through the streaming sink."""
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    scored = ingest.score_stream(ingest.dedupe_stream(_document_stream(spark, folder)), src.WORD_RULES, MODEL)
    rows = scored.select("url", F.round("sme_probability", 9).alias("sme_probability"))
    ingest.append_to_table(rows, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/table")


@query("stream_exact_append", """
SELECT doc_id, md5(text) AS url FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1""")
def stream_exact_append(spark, folder):
    base = f"{shared_dir(spark)}/append-{uuid.uuid4().hex}"
    rows = _document_stream(spark, folder).select("doc_id", "url")
    ingest.exact_append(rows, f"{base}/table", f"{base}/checkpoint", ["doc_id"]).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/table")


@query("stream_keyed_append", """
SELECT md5(text) AS url, min(lower(source)) IS NOT NULL AS has_source FROM documents GROUP BY md5(text)""")
def stream_keyed_append(spark, folder):
    """Every address once, by the state of the stream alone, through the streaming sink."""
    base = f"{shared_dir(spark)}/keyed-{uuid.uuid4().hex}"
    rows = ingest.keyed_stream(_document_stream(spark, folder))
    ingest.append_to_table(rows, f"{base}/table", f"{base}/check").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/table").select("url", F.col("feed").isNotNull().alias("has_source"))
