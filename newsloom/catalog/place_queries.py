"""Gazetteer, place mentions and the country vote."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from newsloom.catalog import inputs as src
from newsloom.catalog.registry import query
from newsloom.functions.cleaning import with_clean_geo
from newsloom.operators import gazetteer as gz
from newsloom.operators import places as pc
from newsloom.operators.rows import explode_rows
from newsloom.plans import pipelines as pl
from newsloom.schemas import GAZETTEER as GAZETTEER_SCHEMA
from newsloom.session import shared_dir
from newsloom.sources import readers

# Parts stand for places: size and key give country, class and region.
GAZETTEER = """gaz AS (SELECT p_partkey AS geonameid, p_name AS name, p_brand || ',' || p_type || ',zz,été' AS alternate_names,
  ['P', 'A', 'H'][(p_partkey % 3 + 1)::INTEGER] AS feature_class,
  ['NL', 'BE', 'DE', 'FR'][p_size % 4 + 1] AS country_code, lpad((p_size % 8)::VARCHAR, 2, '0') AS admin1_code FROM part)"""


def _gazetteer(spark, folder):
    parts = src.table(spark, folder, "part")

    def pick(values, index):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))

    return parts.select(
        F.col("p_partkey").alias("geonameid"),
        F.col("p_name").alias("name"),
        F.concat_ws(",", "p_brand", "p_type", F.lit("zz"), F.lit("été")).alias("alternate_names"),
        pick(["P", "A", "H"], F.col("p_partkey") % 3).alias("feature_class"),
        pick(["NL", "BE", "DE", "FR"], F.col("p_size") % 4).alias("country_code"),
        F.lpad((F.col("p_size") % 8).cast("string"), 2, "0").alias("admin1_code"),
    )


@query("gazetteer_rows", f"""
WITH {GAZETTEER} SELECT geonameid, name FROM gaz WHERE country_code IN ('NL', 'BE', 'DE') AND feature_class IN ('P', 'A')""")
def gazetteer_rows(spark, folder):
    return gz.keep_places(_gazetteer(spark, folder)).select("geonameid", "name")


@query("gazetteer_tsv", f"""
WITH {GAZETTEER} SELECT geonameid, name, alternate_names, feature_class, country_code, admin1_code FROM gaz""")
def gazetteer_tsv(spark, folder):
    """The gazetteer as a dump without a header, and back."""
    path = f"{shared_dir(spark)}/gazetteer-{uuid.uuid4().hex}"
    places = _gazetteer(spark, folder)
    kept = set(places.columns)
    columns = [F.col(f.name) if f.name in kept else F.lit(None).cast("string").alias(f.name) for f in GAZETTEER_SCHEMA.fields]
    places.select(*columns).write.option("sep", "\t").option("quote", "").csv(path)
    return readers.read_gazetteer(spark, path).select(*places.columns)


@query("name_validity", r"""
WITH t AS (SELECT DISTINCT unnest(string_split(replace(lower(text), chr(10), ' '), ' ')) AS name FROM documents)
SELECT name, coalesce(regexp_matches(name, '^[0-9A-Za-zÀ-ÿ\s\-'']+$'), false) AS main_ok,
  coalesce(regexp_matches(name, '^[0-9A-Za-zÀ-ÿ\s\-'']+$'), false) AND length(name) >= 3
    AND regexp_matches(name, '(?i)[aeiouyà-ÿ]') AS alternate_ok FROM t""")
def name_validity(spark, folder):
    docs = src.spread(src.table(spark, folder, "documents"), "doc_id")
    words = F.split(F.replace(F.lower("text"), F.lit("\n"), F.lit(" ")), " ", -1)
    names = explode_rows(docs, words, "name").distinct()
    return names.select("name", gz.valid_main_name(F.col("name")).alias("main_ok"),
                        gz.valid_alternate(F.col("name")).alias("alternate_ok"))


@query("gazetteer_last_wins", rf"""
WITH {GAZETTEER},
kept AS (SELECT * FROM gaz WHERE country_code IN ('NL', 'BE', 'DE') AND feature_class IN ('P', 'A')),
names AS (SELECT lower(trim(name)) AS name_lower, country_code AS cc FROM kept
            WHERE regexp_matches(lower(trim(name)), '^[0-9A-Za-zÀ-ÿ\s\-'']+$')
  UNION ALL SELECT n, country_code FROM (SELECT lower(trim(unnest(string_split(alternate_names, ',')))) AS n, country_code FROM kept)
            WHERE regexp_matches(n, '^[0-9A-Za-zÀ-ÿ\s\-'']+$') AND length(n) >= 3 AND regexp_matches(n, '(?i)[aeiouyà-ÿ]'))
SELECT name_lower, arg_max(cc, list_position(['NL', 'BE', 'DE'], cc)) AS cc FROM names GROUP BY name_lower""")
def gazetteer_last_wins(spark, folder):
    return gz.build_lookup(_gazetteer(spark, folder))


@query("admin_region", f"WITH {GAZETTEER} SELECT DISTINCT lower(name) AS name_lower FROM gaz WHERE admin1_code::INTEGER = 5")
def admin_region(spark, folder):
    return gz.region_names(_gazetteer(spark, folder))


MENTIONS = f"""{src.LOCATED}, {src.LEXICON_SQL},
each AS (SELECT l.doc_id, (t.pos - 1)::INTEGER AS pos, t.loc FROM located l, unnest(l.locations) WITH ORDINALITY AS t(loc, pos)),
mentions AS (SELECT e.doc_id, e.pos, e.loc, x.cc FROM each e JOIN lexicon x ON lower(e.loc) = x.name_lower),
votes AS (SELECT doc_id, count(*) FILTER (cc = 'NL') AS nl, count(*) FILTER (cc = 'BE') AS be, count(*) FILTER (cc = 'DE') AS de
  FROM mentions GROUP BY doc_id),
shares AS (SELECT *, nl + be + de AS total, greatest(nl, be, de) AS best FROM votes),
resolved AS (SELECT doc_id, CASE WHEN total = 0 OR best / total::DOUBLE < 0.6 THEN 'uncertain'
    WHEN nl = best THEN 'NL' WHEN be = best THEN 'BE' ELSE 'DE' END AS country,
  CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE best / total::DOUBLE END AS score FROM shares)"""


def _mentions(spark, folder):
    located = src.located(spark, folder).select("doc_id", "locations")
    return pc.lookup_mentions(pc.explode_locations(located), src.lexicon(spark)).where("cc is not null")


@query("mention_order", f"WITH {MENTIONS} SELECT doc_id, pos, loc FROM each")
def mention_order(spark, folder):
    return pc.explode_locations(src.located(spark, folder))


@query("gazetteer_lookup", f"WITH {MENTIONS} SELECT doc_id, pos, loc, cc FROM mentions")
def gazetteer_lookup(spark, folder):
    return _mentions(spark, folder)


@query("country_votes", f"WITH {MENTIONS} SELECT doc_id, nl AS votes_nl, be AS votes_be, de AS votes_de FROM votes")
def country_votes(spark, folder):
    return pc.vote_counts(_mentions(spark, folder))


@query("country_vote", f"""
WITH {MENTIONS} SELECT d.doc_id, coalesce(r.country, 'uncertain') AS country, round(coalesce(r.score, 0), 9)::DOUBLE AS country_score
FROM documents d LEFT JOIN resolved r ON d.doc_id = r.doc_id""")
def country_vote(spark, folder):
    articles = src.located(spark, folder).withColumnRenamed("locations", "recognised")
    resolved = pl.resolve_countries(
        articles, src.lexicon(spark), candidates=lambda df: pc.explode_locations(df, "recognised"))
    return resolved.select("doc_id", "country", F.round("country_score", 9).alias("country_score"))


@query("country_filter", f"""
WITH {MENTIONS} SELECT doc_id, country FROM resolved WHERE country IN ('NL', 'BE', 'DE') AND score >= 0.8""")
def country_filter(spark, folder):
    return pc.country_filter(pc.vote_countries(_mentions(spark, folder)), 0.8).select("doc_id", "country")


@query("evidence_list", f"""
WITH {MENTIONS} SELECT doc_id, coalesce(string_agg(loc || '=' || cc, ' ' ORDER BY pos) FILTER (cc IN ('NL', 'BE', 'DE')), '') AS evidence
FROM mentions GROUP BY doc_id""")
def evidence_list(spark, folder):
    votes = pc.vote_countries(_mentions(spark, folder))
    shown = F.transform("country_evidence", lambda e: F.concat_ws("=", e["loc"], e["cc"]))
    return votes.select("doc_id", F.array_join(shown, " ").alias("evidence"))


NAME_TOKEN = pc.NAME_TOKEN.replace("'", "''")
STARTS_NAME = pc.STARTS_NAME.replace("'", "''")

CANDIDATES = f"""cleaned AS (SELECT doc_id, nfc_normalize({src.sql_html_to_text("coalesce(text, '')")}) AS clean_geo FROM documents),
toks AS (SELECT doc_id, regexp_extract_all(clean_geo, '{NAME_TOKEN}') AS w FROM cleaned),
starts AS (SELECT doc_id, w, t.pos::INTEGER AS pos FROM toks, unnest(w) WITH ORDINALITY AS t(tok, pos)
  WHERE regexp_matches(t.tok, '{STARTS_NAME}')),
spans AS (SELECT doc_id, pos, n::INTEGER AS words, array_to_string(w[pos:pos + n - 1], ' ') AS loc
  FROM starts, (VALUES (1), (2), (3)) AS s(n) WHERE pos + n - 1 <= len(w)),
{src.LEXICON_SQL},
known AS (SELECT s.*, x.cc FROM spans s JOIN lexicon x ON lower(s.loc) = x.name_lower),
longest AS (SELECT * FROM known QUALIFY words = max(words) OVER (PARTITION BY doc_id, pos)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM longest),
walk(doc_id, k, until, kept) AS (
  SELECT doc_id, k, pos + words, true FROM numbered WHERE k = 1
  UNION ALL
  SELECT n.doc_id, n.k, CASE WHEN n.pos >= w.until THEN n.pos + n.words ELSE w.until END, n.pos >= w.until
  FROM walk w JOIN numbered n ON n.doc_id = w.doc_id AND n.k = w.k + 1),
found AS (SELECT n.doc_id, n.pos, n.loc, n.cc FROM numbered n JOIN walk w ON n.doc_id = w.doc_id AND n.k = w.k WHERE w.kept)"""


def _cleaned(spark, folder):
    docs = src.spread(src.table(spark, folder, "documents"), "doc_id")
    return with_clean_geo(docs, "text").select("doc_id", "clean_geo")


@query("candidate_spans", f"WITH RECURSIVE {CANDIDATES} SELECT doc_id, pos, words, loc FROM spans")
def candidate_spans(spark, folder):
    return pc.candidate_spans(_cleaned(spark, folder))


@query("location_candidates", f"WITH RECURSIVE {CANDIDATES} SELECT doc_id, pos, loc, cc FROM found")
def location_candidates(spark, folder):
    return pc.location_mentions(_cleaned(spark, folder), src.lexicon(spark))

RESOLVED = f"""{CANDIDATES},
counted AS (SELECT doc_id, count(*) FILTER (cc = 'NL') AS nl, count(*) FILTER (cc = 'BE') AS be, count(*) FILTER (cc = 'DE') AS de,
  string_agg(loc, '|' ORDER BY pos) AS locations FROM found GROUP BY doc_id),
shares AS (SELECT *, nl + be + de AS total, greatest(nl, be, de) AS best FROM counted),
resolved AS (SELECT doc_id, CASE WHEN nl = best THEN 'NL' WHEN be = best THEN 'BE' ELSE 'DE' END AS country,
  best / total::DOUBLE AS score, locations FROM shares WHERE total > 0 AND best / total::DOUBLE >= 0.6)"""


@query("geo_resolve", f"""
WITH RECURSIVE {RESOLVED} SELECT doc_id, country, round(score, 9) AS country_score, locations FROM resolved""")
def geo_resolve(spark, folder):
    resolved = pl.geo_resolve(src.articles(spark, folder), src.lexicon(spark))
    return resolved.select("doc_id", "country", F.round("country_score", 9).alias("country_score"),
                           F.array_join("locations", "|").alias("locations"))
