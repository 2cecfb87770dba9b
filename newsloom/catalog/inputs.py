"""The given tables in the shapes the operators expect, for Spark and for SQL.

Documents stand for articles: the source is the feed, the first line the
title, the hash of the text the address (copies share one), and the id sets
the hour of publication. Capitalised words stand for recognised places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.markup import HIDDEN, TAG
from newsloom.functions.strings import SPACE
from newsloom.operators.rules import NOT_SME, SME, Rule, active_rules
from newsloom.sources.readers import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def publication_hour(id_col: str = "doc_id") -> Column:
    return F.timestamp_seconds(F.lit(1704067200) + F.col(id_col) * 3600)


def articles(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread(table(spark, folder, "documents"), "doc_id")
    return docs.select(
        "doc_id",
        F.col("source").alias("feed"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.md5("text").alias("url"),
        publication_hour().alias("published_ts"),
        F.lit("").alias("summary"),
        F.col("text").alias("full_text"),
    )


ARTICLES = """articles AS (
  SELECT doc_id, source AS feed, split_part(text, chr(10), 1) AS title, md5(text) AS url,
         TIMESTAMP '2024-01-01' + to_hours(doc_id) AS published_ts, '' AS summary, text AS full_text
  FROM documents)"""

CAPITALISED = r"\p{Lu}[\p{L}]*"


def located(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with the capitalised words of their whole text as locations."""
    return articles(spark, folder).withColumn(
        "locations", F.regexp_extract_all("full_text", F.lit(CAPITALISED), 0)
    )


LOCATED = f"""{ARTICLES},
located AS (SELECT *, regexp_extract_all(full_text, '{CAPITALISED}') AS locations FROM articles)"""


# --- small dimensions that stand for the gazetteer, coordinates and region ---

# (name, country): the most common words of three of the languages
LEXICON = [
    ("the", "NL"), ("of", "NL"), ("and", "NL"), ("to", "NL"), ("this", "NL"), ("with", "NL"), ("on the", "NL"),
    ("le", "BE"), ("la", "BE"), ("et", "BE"), ("les", "BE"), ("un", "BE"), ("de la", "BE"), ("le les", "BE"),
    ("der", "DE"), ("die", "DE"), ("und", "DE"), ("nicht", "DE"), ("für", "DE"), ("der die", "DE"),
    ("el", "ES"), ("los", "ES"), ("que", "ES"), ("una", "ES"),
]
LEXICON_SQL = "lexicon(name_lower, cc) AS (VALUES " + ", ".join(f"('{n}', '{c}')" for n, c in LEXICON) + ")"


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "name_lower string, cc string")


# Case matters: the lower-case entries match no capitalised word.
PLACES = [
    ("The", 52.1, 5.3), ("Of", 51.4, 6.1), ("the", 50.9, 5.7), ("Le", 50.8, 4.4), ("La", 50.6, 5.6), ("la", 50.5, 4.9),
    ("Der", 51.2, 6.8), ("Die", 50.9, 6.9), ("El", 40.4, -3.7), ("Los", 41.4, 2.2), ("And", 52.4, 4.9),
]
PLACES_SQL = "places(location, lat, lon) AS (VALUES " + ", ".join(
    f"('{n}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for n, a, b in PLACES) + ")"


def coordinates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLACES, "location string, lat double, lon double")


REGION = ["der", "nicht", "le", "un"]
REGION_SQL = "region_names(name_lower) AS (VALUES " + ", ".join(f"('{n}')" for n in REGION) + ")"


def region(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n,) for n in REGION], "name_lower string")


# --- rules over the words of the documents ----------------------------------

WORD_RULES = (
    Rule("r_the", SME, (("the", "this"),)),
    Rule("r_german", NOT_SME, (("der", "die", "und"),)),
    Rule("r_french", NOT_SME, (("le", "la", "les"),)),
    Rule("r_pair", SME, (("and", "et"), ("of", "de"))),
    Rule("r_phrase", SME, ((r"of\s+the", r"on\s+the"),)),
    Rule("r_accent", NOT_SME, (("für", "ré", "über"),)),
    Rule("r_excluding", SME, (("that", "with"),), none_of=("not", "was")),
    Rule("r_inactive", NOT_SME, (("a",),), active=False),
)
RULE_WEIGHTS = (
    ("r_the", SME, 0.8), ("r_german", NOT_SME, -1.1), ("r_french", NOT_SME, -0.9), ("r_pair", SME, 0.4),
    ("r_phrase", SME, 0.7), ("r_accent", NOT_SME, -0.5), ("r_excluding", SME, 0.3),
)


def sql_rule(rule: Rule, text: str) -> str:
    """The rule as a CASE over whole-word patterns, one pattern per term group."""

    def has(terms) -> str:
        body = "|".join(t.replace(r"\s", f"[{SPACE}]").replace("'", "''") for t in terms)
        pattern = rf"(^|[^\p{{L}}\p{{N}}_])({body})($|[^\p{{L}}\p{{N}}_])"
        return f"regexp_matches({text}, '{pattern}')"

    tests = [has(g) for g in rule.groups] + ([f"NOT {has(rule.none_of)}"] if rule.none_of else [])
    return f"CASE WHEN {' AND '.join(tests)} THEN {rule.vote} ELSE -1 END AS {rule.name}"


def votes_sql(rules=WORD_RULES) -> str:
    return "votes AS (SELECT doc_id, " + ",\n  ".join(sql_rule(r, "lower(text)") for r in active_rules(rules)) + " FROM documents)"


# --- SQL forms of the text functions -----------------------------------------


def sql_collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[{SPACE}]+', ' ', 'g'))"


def sql_hidden(x: str) -> str:
    return f"regexp_replace({x}, '{HIDDEN}', ' ', 'g')"


def sql_tags(x: str) -> str:
    return f"regexp_replace({x}, '{TAG}', ' ', 'g')"


def sql_entities(x: str) -> str:
    """The references that occur in the tables; the ampersand comes last."""
    for ref, char in (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"),
                      ("&#39;", "''''"), ("&apos;", "''''"), ("&copy;", "'©'"), ("&middot;", "'·'"), ("&amp;", "'&'")):
        x = f"replace({x}, '{ref}', {char})"
    return x


def sql_html_to_text(x: str) -> str:
    return sql_entities(sql_tags(sql_hidden(x)))


def sql_clean(x: str) -> str:
    text = sql_html_to_text(f"coalesce({x}, '')")
    text = rf"regexp_replace({text}, '^\s*#?\d+\s*[-–—:]\s*', '')"
    text = f"translate({text}, '@#', '  ')"
    text = rf"regexp_replace({text}, '[^0-9A-Za-zÀ-ÿ\s]', ' ', 'g')"
    return rf"lower(trim(regexp_replace({text}, '\s+', ' ', 'g')))"
