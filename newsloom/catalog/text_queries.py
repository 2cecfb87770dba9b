"""Text cleaning, tokens, vocabularies and keywords."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.catalog import inputs as src
from newsloom.catalog.registry import query
from newsloom.functions import cleaning as cl
from newsloom.functions import markup as mk
from newsloom.functions import strings as st
from newsloom.operators import keywords as kw
from newsloom.operators import vocabulary as vo
from newsloom.operators.rows import explode_rows
from newsloom.plans import pipelines as pl
from newsloom.rules.stopwords import DUTCH
from newsloom.sources.staging import stage


def _docs(spark, folder):
    return src.spread(src.table(spark, folder, "documents"), "doc_id")


def _clean(spark, folder):
    return cl.with_clean(_docs(spark, folder), "text").select("doc_id", "clean")


CLEAN = f"clean AS (SELECT doc_id, {src.sql_clean('text')} AS clean FROM documents)"
STOP = "(" + ", ".join(f"'{w}'" for w in DUTCH) + ")"
WS_WORDS = f"""{CLEAN},
words AS (SELECT doc_id, t.word, t.pos FROM clean,
  unnest(string_split(clean, ' ')) WITH ORDINALITY AS t(word, pos) WHERE t.word <> '')"""
TRAIN = "SELECT doc_id FROM documents WHERE ('0x' || substr(md5(doc_id::VARCHAR || ':42'), 1, 8))::BIGINT % 100 < 80"


# --- cleaning scalars ---------------------------------------------------------


@query("blank_guard", r"""
SELECT conv_id, turn, CASE WHEN regexp_matches(text, '[^\s\p{Z}]') THEN text ELSE '' END AS guarded
FROM conversations""")
def blank_guard(spark, folder):
    return src.table(spark, folder, "conversations").select("conv_id", "turn", st.blank_to_empty("text").alias("guarded"))


# the tables hold no compatibility characters, so composing is all there is to do
@query("nfkc", "SELECT doc_id, nfc_normalize(text) AS normal FROM documents")
def nfkc(spark, folder):
    return _docs(spark, folder).select("doc_id", cl.nfkc("text").alias("normal"))


@query("strip_number_header", r"""
SELECT doc_id, regexp_replace('#' || doc_id || ' - ' || text, '^\s*#?\d+\s*[-–—:]\s*', '') AS body FROM documents""")
def strip_number_header(spark, folder):
    headed = F.concat(F.lit("#"), F.col("doc_id").cast("string"), F.lit(" - "), F.col("text"))
    return _docs(spark, folder).select("doc_id", cl.strip_number_header(headed).alias("body"))


@query("tag_symbols_to_blank", "SELECT doc_id, translate(text, '@#', '  ') AS untagged FROM documents")
def tag_symbols_to_blank(spark, folder):
    return _docs(spark, folder).select("doc_id", cl.tags_to_blank("text").alias("untagged"))


@query("punct_to_space", r"SELECT doc_id, regexp_replace(text, '[^0-9A-Za-zÀ-ÿ\s]', ' ', 'g') AS words FROM "
                         r"(SELECT doc_id, regexp_replace(text, '\s', ' ', 'g') AS text FROM documents)")
def punct_to_space(spark, folder):
    return _docs(spark, folder).select("doc_id", cl.punct_to_space("text").alias("words"))


@query("collapse_lower", r"SELECT doc_id, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS low FROM documents")
def collapse_lower(spark, folder):
    return _docs(spark, folder).select("doc_id", cl.collapse_lower("text").alias("low"))


@query("clean_text", f"WITH {CLEAN} SELECT doc_id, clean FROM clean")
def clean_text(spark, folder):
    return _clean(spark, folder)


@query("clean_text_geo", f"""
SELECT page_id, nfc_normalize({src.sql_html_to_text("html")}) AS clean_geo FROM pages""")
def clean_text_geo(spark, folder):
    pages = src.spread(src.table(spark, folder, "pages"), "page_id")
    return cl.with_clean_geo(pages, "html").select("page_id", "clean_geo")


@query("tag_split")
def tag_split(spark, folder):
    """Tags split with the costs of the corpus' own words; needs a word segmenter, so no SQL."""
    words = vo.top_words(vo.word_counts(_clean(spark, folder).select(cl.ws_tokens("clean").alias("tokens"))))
    costs = cl.word_costs([r["word"] for r in words.collect()])
    docs = _docs(spark, folder)
    return docs.select("doc_id", cl.split_tags("text", costs).alias("split"))


@query("ws_tokens", f"""
WITH {CLEAN} SELECT doc_id, array_to_string(list_filter(string_split(clean, ' '), lambda t: t <> ''), '|') AS tokens,
  len(list_filter(string_split(clean, ' '), lambda t: t <> ''))::INTEGER AS n FROM clean""")
def ws_tokens(spark, folder):
    tokens = _clean(spark, folder).select("doc_id", cl.ws_tokens("clean").alias("t"))
    return tokens.select("doc_id", F.array_join("t", "|").alias("tokens"), F.size("t").alias("n"))


@query("word_tokens", r"""
SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}'), '|') AS tokens FROM documents""")
def word_tokens(spark, folder):
    return _docs(spark, folder).select("doc_id", F.array_join(cl.word_tokens("text"), "|").alias("tokens"))


@query("stopword_filter", rf"""
SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}'),
  lambda t: t NOT IN {STOP}), '|') AS tokens FROM documents""")
def stopword_filter(spark, folder):
    tokens = cl.drop_stopwords(cl.word_tokens("text"), cl.stopwords())
    return _docs(spark, folder).select("doc_id", F.array_join(tokens, "|").alias("tokens"))


@query("nonempty_corpus", f"""
WITH t AS (SELECT conv_id * 200 + turn * 2 AS doc_id, text FROM conversations
  UNION ALL SELECT conv_id * 200 + turn * 2 + 1, '<p>&nbsp;</p> -' FROM conversations),
c AS (SELECT doc_id, {src.sql_clean('text')} AS clean FROM t)
SELECT doc_id FROM c WHERE clean <> ''""")
def nonempty_corpus(spark, folder):
    """Turns that still have text after cleaning, beside as many that hold markup and blanks only."""
    turns = src.table(spark, folder, "conversations")
    number = F.col("conv_id") * 200 + F.col("turn") * 2
    blank = turns.select((number + 1).alias("doc_id"), F.lit("<p>&nbsp;</p> -").alias("full_text"))
    talk = turns.select(number.alias("doc_id"), F.col("text").alias("full_text")).unionByName(blank)
    articles = talk.withColumns({"title": F.lit(""), "summary": F.lit("")})
    return pl.tokenized(articles).where("terms is not null").select("doc_id")


# --- vocabulary ---------------------------------------------------------------


@query("split_80_20", f"SELECT doc_id, CASE WHEN doc_id IN ({TRAIN}) THEN 'train' ELSE 'test' END AS split FROM documents")
def split_80_20(spark, folder):
    return vo.train_test_split(src.table(spark, folder, "documents").select("doc_id"))


def _train_tokens(spark, folder):
    docs = _docs(spark, folder).where(vo.split_bucket("doc_id") < 80)
    return cl.with_clean(docs, "text").select("doc_id", cl.ws_tokens("clean").alias("tokens"))


@query("word_counts", f"WITH {WS_WORDS} SELECT word, count(*) AS n FROM words WHERE doc_id IN ({TRAIN}) GROUP BY word")
def word_counts(spark, folder):
    return vo.word_counts(_train_tokens(spark, folder))


VOCAB = f"""{WS_WORDS},
vocab AS (SELECT word, count(*) AS n FROM words WHERE doc_id IN ({TRAIN}) GROUP BY word ORDER BY n DESC, word LIMIT {vo.MAX_WORDS})"""


@query("vocab_topn", f"WITH {VOCAB} SELECT word, n FROM vocab")
def vocab_topn(spark, folder):
    return vo.top_words(vo.word_counts(_train_tokens(spark, folder)))


@query("tokens_unk", f"""
WITH {VOCAB}
SELECT d.doc_id, coalesce(string_agg(coalesce(v.word, '<unk>'), ' ' ORDER BY w.pos) FILTER (w.word IS NOT NULL), '') AS tokens
FROM documents d LEFT JOIN words w ON d.doc_id = w.doc_id LEFT JOIN vocab v ON w.word = v.word GROUP BY d.doc_id""")
def tokens_unk(spark, folder):
    marked, _ = pl.word_tokens(src.articles(spark, folder))
    return marked.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query("oov_rate", f"""
WITH {VOCAB}
SELECT count(*) AS total, count(*) FILTER (v.word IS NULL) AS oov,
       round(count(*) FILTER (v.word IS NULL) / count(*)::DOUBLE, 9) AS rate
FROM words w LEFT JOIN vocab v ON w.word = v.word WHERE w.doc_id IN ({TRAIN})""")
def oov_rate(spark, folder):
    marked, _ = pl.word_tokens(src.articles(spark, folder))
    rate = vo.oov_rate(marked.where("split = 'train'"))
    return rate.select("total", "oov", F.round("rate", 9).alias("rate"))


# --- TF-IDF -------------------------------------------------------------------

FEATURES = kw.MAX_FEATURES

TERMS = f"""{CLEAN},
terms AS (SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(string_split(translate(clean, '×÷', '  '), ' ')) AS term FROM clean)
  WHERE length(term) >= 2 AND term NOT IN {STOP} GROUP BY doc_id, term),
corpus AS (SELECT count(*) AS docs FROM clean WHERE clean <> ''),
features AS (SELECT term, sum(tf)::BIGINT AS n, count(*) AS df FROM terms GROUP BY term ORDER BY n DESC, term LIMIT {FEATURES}),
idf AS (SELECT term, n, df, log10(docs / df::DOUBLE) AS idf FROM features, corpus),
weighted AS (SELECT t.doc_id, t.term, t.tf, t.tf * i.idf AS tfidf FROM terms t JOIN idf i ON t.term = i.term),
term_scores AS (SELECT doc_id, term, tfidf / sqrt(sum(tfidf * tfidf) OVER (PARTITION BY doc_id)) AS score
  FROM weighted WHERE tfidf > 0),
ranked AS (SELECT doc_id, term, score, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, term) AS rn
  FROM term_scores),
top10 AS (SELECT doc_id, term, score, rn FROM ranked WHERE rn <= 10),
leaders AS (SELECT term AS word, sum(score) AS score FROM top10 GROUP BY term)"""


def _terms(spark, folder):
    return pl.tokenized(src.articles(spark, folder))


def _keywords(spark, folder):
    return pl.keywords(src.articles(spark, folder), max_features=FEATURES)


@query("term_freq", f"WITH {TERMS} SELECT doc_id, term, tf FROM terms")
def term_freq(spark, folder):
    pairs = explode_rows(_terms(spark, folder), "terms", "t", ["doc_id"])
    return pairs.select("doc_id", "t.term", F.col("t.tf").cast("long").alias("tf"))


@query("feature_cutoff", f"WITH {TERMS} SELECT term, n FROM features")
def feature_cutoff(spark, folder):
    return kw.term_idf(_terms(spark, folder), FEATURES).select("term", "n")


@query("term_idf", f"WITH {TERMS} SELECT term, df, round(idf, 9) AS idf FROM idf")
def term_idf(spark, folder):
    return kw.term_idf(_terms(spark, folder), FEATURES).select("term", "df", F.round("idf", 9).alias("idf"))


@query("idf_join", f"WITH {TERMS} SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM weighted")
def idf_join(spark, folder):
    terms = stage(_terms(spark, folder), "terms")  # for the weights and for the join
    weighed = kw.weigh_terms(terms, kw.term_idf(terms, FEATURES))
    return weighed.select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


@query("l2_norm", f"""
WITH {TERMS} SELECT doc_id, round(sqrt(sum(tfidf * tfidf)), 6) AS norm FROM weighted GROUP BY doc_id""")
def l2_norm(spark, folder):
    terms = stage(_terms(spark, folder), "terms")  # for the weights and for the join
    weighed = kw.weigh_terms(terms, kw.term_idf(terms, FEATURES))
    return weighed.groupBy("doc_id").agg(F.round(F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf"))), 6).alias("norm"))


@query("doc_keywords_topk", f"""
WITH {TERMS}
SELECT c.doc_id, coalesce(string_agg(t.term || ':' || printf('%.6f', t.score), ' ' ORDER BY t.rn), '') AS keywords
FROM clean c LEFT JOIN top10 t ON c.doc_id = t.doc_id GROUP BY c.doc_id""")
def doc_keywords_topk(spark, folder):
    shown = F.transform("keywords", lambda k: F.format_string("%s:%.6f", k["word"], k["score"]))
    return _keywords(spark, folder).select("doc_id", F.array_join(shown, " ").alias("keywords"))


@query("keyword_valid", f"WITH {TERMS} SELECT doc_id, term AS word, round(score, 6) AS score FROM top10")
def keyword_valid(spark, folder):
    each = explode_rows(_keywords(spark, folder), "keywords", "k", ["doc_id"]).select("doc_id", "k.*")
    whole = each.where(F.col("word").isNotNull() & F.col("score").isNotNull())
    return whole.select("doc_id", "word", F.round("score", 6).alias("score"))


@query("global_keywords", f"WITH {TERMS} SELECT word, round(score, 5) AS score FROM leaders")
def global_keywords(spark, folder):
    return kw.keyword_scores(_keywords(spark, folder)).select("word", F.round("score", 5).alias("score"))


@query("top_keywords", f"""
WITH {TERMS} SELECT word, round(score, 6) AS score FROM leaders ORDER BY round(score, 9) DESC, word LIMIT 20""")
def top_keywords(spark, folder):
    return pl.top_keywords(_keywords(spark, folder)).select("word", F.round("score", 6).alias("score"))


# the keyword stage on the training share only
@query("top_keywords_train", "WITH " + TERMS.replace(
    "FROM documents)", f"FROM documents WHERE doc_id IN ({TRAIN}))", 1) + """
SELECT word, round(score, 6) AS score FROM leaders ORDER BY round(score, 9) DESC, word LIMIT 20""")
def top_keywords_train(spark, folder):
    train = src.articles(spark, folder).where(vo.split_bucket("doc_id") < 80)
    best = pl.top_keywords(pl.keywords(train, max_features=FEATURES))
    return best.select("word", F.round("score", 6).alias("score"))


# --- markup -------------------------------------------------------------------

VISIBLE = f"visible AS (SELECT page_id, url, html, {src.sql_hidden('html')} AS v FROM pages)"


def sql_text(x: str) -> str:
    return src.sql_collapse(src.sql_entities(src.sql_tags(x)))


def sql_paragraphs(x: str) -> str:
    piece = r"split_part(regexp_replace(x, '(?i)</p\s*>', '</p>', 'g'), '</p>', 1)"
    return (rf"list_filter(list_transform(string_split_regex({x}, '(?i)<p(?:\s[^>]*)?>')[2:], "
            rf"lambda x: {sql_text(piece)}), lambda x: x <> '')")


def sql_container(x: str) -> str:
    def inner(name: str) -> str:
        return rf"nullif(regexp_extract({x}, '(?is)<{name}(?:\s[^>]*)?>(.*?)</{name}\s*>', 1), '')"

    return f"coalesce({inner('article')}, {inner('main')}, {x})"


BLOCKS = rf"""{VISIBLE},
chosen AS (SELECT *, {sql_container('v')} AS inner_html FROM visible),
blocks AS (SELECT page_id, url, v, inner_html <> v AS marked,
  list_transform(string_split_regex(CASE WHEN inner_html <> v THEN '<p>' || inner_html ELSE v END, '{mk.BLOCK_START}')[2:],
  lambda x: {{'text': {sql_text('x')},
              'plain': length({sql_text(f"regexp_replace(x, '{mk.ANCHOR}', ' ', 'g')")})}}) AS b FROM chosen),
main AS (SELECT page_id, url, v, array_to_string(list_transform(list_filter(b,
  lambda k: k.text <> '' AND k.plain >= length(k.text) * 0.67::DOUBLE
    AND (marked OR (length(k.text) >= 25 AND regexp_matches(k.text, '[.,;:!?]')))),
  lambda k: k.text), ' ') AS main_text FROM blocks)"""

PAGE_TEXTS = f"""{BLOCKS},
texts AS (SELECT page_id, url, v, main_text, array_to_string({sql_paragraphs(sql_container('v'))}, ' ') AS inner_text,
  array_to_string({sql_paragraphs('v')}, ' ') AS para_text FROM main)"""


def _pages(spark, folder):
    return src.spread(src.table(spark, folder, "pages"), "page_id")


@query("html_to_text", f"SELECT page_id, {src.sql_html_to_text('html')} AS text FROM pages")
def html_to_text(spark, folder):
    return _pages(spark, folder).select("page_id", mk.html_to_text("html").alias("text"))


@query("page_paragraphs", f"""
WITH {VISIBLE} SELECT page_id, array_to_string({sql_paragraphs('v')}, chr(10)) AS text FROM visible""")
def page_paragraphs(spark, folder):
    return _pages(spark, folder).select("page_id", mk.paragraph_text(mk.drop_hidden("html"), "\n").alias("text"))


@query("container_select", f"WITH {VISIBLE} SELECT page_id, {sql_container('v')} AS inner_html FROM visible")
def container_select(spark, folder):
    return _pages(spark, folder).select("page_id", mk.container("html").alias("inner_html"))


@query("page_main_text", f"WITH {BLOCKS} SELECT page_id, main_text FROM main")
def page_main_text(spark, folder):
    return _pages(spark, folder).select("page_id", mk.main_text("html").alias("main_text"))


@query("min_words_gate", f"""
WITH {PAGE_TEXTS}
SELECT page_id, CASE WHEN len(list_filter(string_split(main_text, ' '), lambda w: w <> '')) > 40
  THEN main_text ELSE para_text END AS text FROM texts""")
def min_words_gate(spark, folder):
    gated = mk.min_words_gate(mk.main_text("html"), mk.paragraph_text(mk.drop_hidden("html")))
    return _pages(spark, folder).select("page_id", gated.alias("text"))


LISTING_ITEM = r"(?is)<li(?:\s[^>]*)?>(.*?)</li\s*>"
LISTING_FIELDS = {"title": r"(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>", "href": r"""(?is)<a\s[^>]*href="([^"]*)"[^>]*>"""}
ORIGIN = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#:]*)', 1)"


@query("page_listing_rows", f"""
WITH {VISIBLE},
items AS (SELECT page_id, url, (t.pos - 1)::INTEGER AS item_no, t.item FROM visible,
  unnest(regexp_extract_all(v, '{LISTING_ITEM}', 1)) WITH ORDINALITY AS t(item, pos)),
parts AS (SELECT page_id, url, item_no, {src.sql_collapse(src.sql_html_to_text(f"regexp_extract(item, '{LISTING_FIELDS['title']}', 1)"))} AS title,
  regexp_extract(item, '{LISTING_FIELDS['href']}', 1) AS raw FROM items)
SELECT page_id, item_no, title, CASE WHEN raw LIKE '/%' THEN {ORIGIN} || raw ELSE raw END AS href FROM parts""")
def page_listing_rows(spark, folder):
    from newsloom.operators.listing import listing_rows

    rows = listing_rows(_pages(spark, folder), LISTING_ITEM, LISTING_FIELDS)
    return rows.select("page_id", "item_no", "title", "href")


@query("best_link", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || '?alt' WHEN page_id % 3 = 1 THEN url
  ELSE url || '/page' END AS url FROM pages""")
def best_link(spark, folder):
    """Entries with an alternate, with a usable own link, and with audio as own link."""
    kind = F.col("page_id") % 3
    link = F.struct(
        F.when(kind == 0, F.concat("url", F.lit("?alt"))).when(kind == 1, F.concat("url", F.lit(".mp3")))
        .otherwise(F.concat("url", F.lit("/page"))).alias("href"),
        F.when(kind == 0, F.lit("alternate")).otherwise(F.lit("enclosure")).alias("rel"),
        F.when(kind == 0, F.lit("text/html")).otherwise(F.lit("audio/mpeg")).alias("type"),
    )
    own = F.when(kind == 2, F.concat("url", F.lit(".MP3"))).otherwise(F.col("url"))
    return src.table(spark, folder, "pages").select("page_id", mk.best_link(F.array(link), own, F.lit(None).cast("string")).alias("url"))


@query("non_html_guard", r"""
WITH u AS (SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '.MP3' WHEN 1 THEN '.pdf' WHEN 2 THEN '.html' ELSE '' END AS url FROM pages)
SELECT page_id, url, regexp_matches(url, '[^\s]') AND NOT regexp_matches(lower(url), '\.(mp3|m4a|aac|ogg|wav|zip|pdf)$') AS is_page FROM u""")
def non_html_guard(spark, folder):
    pages = src.table(spark, folder, "pages")
    ends = F.when(F.col("page_id") % 4 == 0, ".MP3").when(F.col("page_id") % 4 == 1, ".pdf").when(
        F.col("page_id") % 4 == 2, ".html").otherwise("")
    urls = pages.select("page_id", F.concat("url", ends).alias("url"))
    return urls.withColumn("is_page", mk.is_page_url("url"))


@query("url_resolve", f"""
WITH l AS (SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN '/item/' || page_id ELSE 'https://other.example/' || page_id END AS link FROM pages)
SELECT page_id, CASE WHEN link LIKE '/%' THEN {ORIGIN} || link ELSE link END AS resolved FROM l""")
def url_resolve(spark, folder):
    pages = src.table(spark, folder, "pages")
    number = F.col("page_id").cast("string")
    link = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/item/"), number)).otherwise(
        F.concat(F.lit("https://other.example/"), number))
    return pages.select("page_id", mk.resolve_url("url", link).alias("resolved"))


@query("pages_to_articles", rf"""
WITH {PAGE_TEXTS},
picked AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) AS feed,
  {src.sql_collapse(src.sql_html_to_text(r"regexp_extract(v, '(?is)<title[^>]*>(.*?)</title\s*>', 1)"))} AS title, url,
  {src.sql_collapse("CASE WHEN len(list_filter(string_split(main_text, ' '), lambda w: w <> '')) > 40 THEN main_text "
                    "WHEN inner_text <> '' THEN inner_text ELSE para_text END")} AS full_text
  FROM texts WHERE NOT regexp_matches(lower(url), '\.(mp3|m4a|aac|ogg|wav|zip|pdf)$'))
SELECT page_id, feed, title, url, full_text FROM picked
QUALIFY row_number() OVER (PARTITION BY feed, url ORDER BY page_id) = 1""")
def pages_to_articles(spark, folder):
    return pl.pages_to_articles(_pages(spark, folder), ["page_id"])
