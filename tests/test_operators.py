import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import dedupe as dd
from newsloom.operators import explore as ex
from newsloom.operators import filters as fl
from newsloom.operators import gazetteer as gz
from newsloom.operators import keywords as kw
from newsloom.operators import label_model as lm
from newsloom.operators import lookup as lk
from newsloom.sources.staging import stage
from newsloom.operators import places as pc
from newsloom.operators import rules as ru
from newsloom.operators import vocabulary as vo
from newsloom.operators.listing import listing_rows
from newsloom.rules.dutch_sme import RULES


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- lookup -----------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_same_rows_with_and_without_broadcast(spark, how):
    left = spark.range(200).select("id", F.when(F.col("id") < 120, F.lit(7)).otherwise(F.col("id") % 20).cast("int").alias("k"))
    right = spark.createDataFrame([(7, "x"), (3, "y"), (3, "z"), (99, "w")], "k int, v string")
    small = lk.lookup_join(left, right, "k", how, ["id"])
    large = lk.lookup_join(left, right, "k", how, ["id"], max_rows=2)
    assert "BroadcastExchange" in plan(small)
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.collect()), key=str)
    # the hot key of the large form is spread over many tasks
    salted = left.select(F.pmod(F.xxhash64("id"), F.lit(lk.SALTS)).alias("s"), "k").where("k = 7").distinct()
    assert salted.count() > 16


def test_fits_broadcast_measures(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 100).alias("v"))
    assert lk.fits_broadcast(df)
    assert not lk.fits_broadcast(df, max_rows=99)
    assert not lk.fits_broadcast(df, max_bytes=5000)
    assert lk.collect_bounded(df, "v", 99) is None
    assert len(lk.collect_bounded(df, "v", 100)) == 100


# --- de-duplication -----------------------------------------------------------


def test_url_dedupe_and_policies(spark):
    df = spark.createDataFrame(
        [(1, "f", "u1"), (2, "f", "u1"), (3, "g", "u1"), (4, "f", ""), (5, "f", " "), (6, "f", None)],
        "pos int, feed string, url string",
    )
    assert rows(dd.url_dedupe(df, ["pos"]), "pos") == [(1,)]
    assert rows(dd.feed_dedupe(df, ["pos"]), "pos") == [(1,), (3,), (4,), (5,), (6,)]
    assert rows(dd.feed_dedupe(df, ["pos"], blank="drop"), "pos") == [(1,), (3,)]
    assert "WindowGroupLimit" in plan(dd.url_dedupe(df, ["pos"]))
    again = dd.url_dedupe(dd.url_dedupe(df, ["pos"]), ["pos"])
    assert rows(again, "pos") == [(1,)]


def test_heads(spark):
    df = spark.createDataFrame([("b", 1), ("b", 2), ("a", 3), ("c", 4), (None, 5)], "feed string, pos int")
    assert rows(dd.head_per_feed(df.where("feed is not null"), 1, ["pos"]), "feed", "pos") == [("a", 3), ("b", 1), ("c", 4)]
    assert dd.head_per_feed(df, 0, ["pos"]).count() == 5
    assert rows(dd.head_feeds(df, 2), "pos") == [(1,), (2,), (3,)]
    assert rows(dd.head_feeds(df, 2, feed_order="pos"), "pos") == [(1,), (2,), (3,)]


def test_long_heads_of_a_hot_feed(spark):
    df = spark.range(20000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 50)).alias("feed"))
    got = dd.head_per_feed(df, 1500, ["id"])
    local = {}
    for i in range(20000):
        local.setdefault("hot" if i % 3 == 0 else f"f{i % 50}", []).append(i)
    want = sorted((i, f) for f, ids_ in local.items() for i in ids_[:1500])
    assert rows(got, "id", "feed") == want


def test_new_only_hot_address(spark):
    incoming = spark.range(5000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("url"))
    existing = spark.createDataFrame([("1",), ("1",), ("",), (None,)], "url string")
    got = dd.new_only(incoming, existing, ["id"])
    assert got.count() == 3333 - 1 + 1
    assert got.where("url = 'hot'").first()["id"] == 0


def test_union_sources(spark):
    a = spark.createDataFrame([("1", "x")], "url string, title string")
    b = spark.createDataFrame([("2",)], "url string")
    assert rows(dd.union_sources(a, b), "url", "title") == [("1", "x"), ("2", None)]
    assert dd.union_distinct(a, a, b).count() == 2


# --- vocabulary ---------------------------------------------------------------


def test_vocabulary(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["c'", "a"]), (3, []), (4, None)], "doc_id int, tokens array<string>")
    counts = vo.word_counts(df)
    assert rows(counts, "word", "n") == [("a", 3), ("b", 1), ("c'", 1)]
    top = vo.top_words(counts, 2)
    assert rows(top, "word") == [("a",), ("b",)]
    marked = vo.mark_unknown(df, top)
    assert rows(marked.where("tokens is not null"), "doc_id", "tokens") == [(1, ["a", "b", "a"]), (2, ["<unk>", "a"]), (3, [])]
    assert tuple(vo.oov_rate(marked).first()) == (5, 1, 0.2)
    assert vo.mark_unknown(df, vo.top_words(counts, 3)).where("array_contains(tokens, '<unk>')").count() == 0
    # a vocabulary too large for a literal set is joined, with the same result
    joined = vo.mark_unknown(df, top, max_values=1)
    assert joined.columns == df.columns and sorted(map(str, joined.collect())) == sorted(map(str, marked.collect()))


def test_split_is_reproducible(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    first = rows(vo.train_test_split(df), "doc_id", "split")
    assert first == rows(vo.train_test_split(df.repartition(3)), "doc_id", "split")
    assert 0.78 < sum(s == "train" for _, s in first) / 5000 < 0.82


# --- keywords -----------------------------------------------------------------


def brute_keywords(docs, max_features, k):
    import math
    from collections import Counter

    texts = {d: t for d, t in docs.items() if t is not None}
    total = Counter(w for t in texts.values() for w in t)
    kept = [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:max_features]]
    df = {w: sum(w in t for t in texts.values()) for w in kept}
    out = {}
    for d, tokens in docs.items():
        tf = Counter(w for w in tokens or [] if w in df)
        weights = {w: n * math.log10(len(texts) / df[w]) for w, n in tf.items()}
        weights = {w: x for w, x in weights.items() if x > 0}
        norm = math.sqrt(sum(x * x for x in weights.values())) or 1
        best = sorted(weights.items(), key=lambda x: (-round(x[1] / norm, 9), x[0]))[:k]
        out[d] = [(w, pytest.approx(x / norm)) for w, x in best]
    return out


@pytest.mark.parametrize("max_features,k", [(1000, 10), (15, 3)])
def test_keywords_against_brute_force(spark, max_features, k):
    rng = np.random.default_rng(5)
    docs = {i: [f"w{int(x)}" for x in rng.zipf(1.5, rng.integers(1, 40)) if x < 60] for i in range(60)}
    docs[60], docs[61], docs[62] = None, [], ["only"]
    df = spark.createDataFrame(list(docs.items()), "doc_id int, tokens array<string>")
    terms = kw.with_terms(df).select("doc_id", "terms")
    got = kw.document_keywords(terms, kw.term_idf(terms, max_features), k)
    # weights that are joined instead of looked up in the row, and more features than meet in one row: the same keywords
    joined = kw.document_keywords(terms, kw.term_idf(terms, max_features), k, in_row=1)
    assert {r[0]: r[1] for r in joined.collect()} == {r[0]: r[1] for r in got.collect()}
    plan = kw.document_keywords(stage(terms, "t"), stage(kw.term_idf(terms, max_features), "i"), k)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(kw, "BROADCAST_ROWS", 10)
        large = kw.document_keywords(terms, kw.term_idf(terms, max_features), k)
        assert {r[0]: [(x.word, round(x.score, 9)) for x in r[1]] for r in large.collect()} == {
            r[0]: [(x.word, round(x.score, 9)) for x in r[1]] for r in got.collect()}
    found = {r.doc_id: [(x.word, x.score) for x in r.keywords] for r in got.collect()}
    assert found == brute_keywords(docs, max_features, k)
    assert all(0 < s <= 1 + 1e-12 for ks in found.values() for _, s in ks)
    leaders = kw.leaderboard(kw.keyword_scores(got), 5).collect()
    sums = {}
    for ks in found.values():
        for w, s in ks:
            sums[w] = sums.get(w, 0) + s
    assert [r.word for r in leaders] == [w for w, _ in sorted(sums.items(), key=lambda x: (-round(x[1], 9), x[0]))[:5]]


def test_keyword_scan_is_single_and_text_is_computed_once(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a d")], "doc_id int, text string")
    tokens = df.select("doc_id", F.split("text", " ").alias("tokens"))
    text = plan(kw.term_idf(kw.with_terms(tokens)))
    assert text.count("split(") == 1


def test_keyword_entries_must_be_complete(spark):
    df = spark.createDataFrame([([("a", 0.5), ("b", None), (None, 1.0)],), (None,)], "keywords array<struct<word:string,score:double>>")
    assert rows(kw.explode_keywords(df), "word", "score") == [("a", 0.5)]
    assert not kw.enough_articles(df)
    assert kw.enough_articles(df.union(df))


# --- gazetteer and votes --------------------------------------------------------


def gazetteer(spark):
    data = [
        (1, "Maastricht", "Mestreech,Ма,xy,bcdf,Maestricht", "P", "NL", "05"),
        (2, "Visé", "Wezet", "P", "BE", "01"),
        (3, "Aachen", "Aken,Aix", "A", "DE", "5"),
        (4, "Berg", None, "P", "NL", "05"),
        (5, "Berg", "", "P", "DE", "07"),
        (6, "River", "", "H", "NL", "05"),
        (7, "Paris", "", "P", "FR", "11"),
        (8, "Мосt", "", "P", "NL", "xx"),
    ]
    return spark.createDataFrame(data, "geonameid int, name string, alternate_names string, feature_class string, country_code string, admin1_code string")


def test_gazetteer_lookup(spark):
    lookup = {r.name_lower: r.cc for r in gz.build_lookup(gazetteer(spark)).collect()}
    assert lookup == {
        "maastricht": "NL", "mestreech": "NL", "maestricht": "NL", "visé": "BE", "wezet": "BE",
        "aachen": "DE", "aken": "DE", "aix": "DE", "berg": "DE",
    }
    assert rows(gz.region_names(gazetteer(spark)), "name_lower") == [("aachen",), ("berg",), ("maastricht",), ("river",)]


def test_votes(spark):
    df = spark.createDataFrame(
        [(1, ["Maastricht", "Aken", "maastricht", "Nergens"]), (2, ["Aken", "Visé"]), (3, ["Paris"]), (4, []), (5, None)],
        "doc_id int, locations array<string>",
    )
    lookup = gz.build_lookup(gazetteer(spark)).union(spark.createDataFrame([("paris", "FR")], "n string, c string"))
    mentions = pc.lookup_mentions(pc.explode_locations(df), lookup)
    votes = {r.doc_id: r for r in pc.vote_countries(mentions).collect()}
    # places the lookup does not know stay among the locations, but have no vote
    assert votes[1].locations == ["Maastricht", "Aken", "maastricht", "Nergens"]
    assert votes[1].country == "NL" and votes[1].country_score == pytest.approx(2 / 3)
    assert [(e.loc, e.cc) for e in votes[1].country_evidence] == [("Maastricht", "NL"), ("Aken", "DE"), ("maastricht", "NL")]
    assert votes[2].country == "uncertain" and votes[2].country_score == 0.5 and len(votes[2].country_evidence) == 2
    assert votes[3].country == "uncertain" and votes[3].country_score == 0.0 and votes[3].country_evidence == []
    assert set(votes) == {1, 2, 3}
    tie = pc.pick_winner(spark.createDataFrame([(1, 1, 1)], "votes_nl int, votes_be int, votes_de int"), 0.3).first()
    assert tie.country == "NL"
    with pytest.raises(ValueError):
        pc.country_filter(df)


def test_longest_name_wins(spark):
    df = spark.createDataFrame([(1, "Den Haag en Haag, Bergen op Zoom. 's-Hertogenbosch ligt in Nederland")], "doc_id int, clean_geo string")
    names = ["den haag", "haag", "bergen op zoom", "bergen", "zoom", "'s-hertogenbosch", "nederland"]
    lookup = spark.createDataFrame([(n, "NL") for n in names], "name_lower string, cc string")
    got = pc.location_mentions(df, lookup).orderBy("pos").collect()
    assert [r.loc for r in got] == ["Den Haag", "Haag", "Bergen op Zoom", "'s-Hertogenbosch", "Nederland"]
    chain = spark.createDataFrame([(1, "In Den Haag Zuid Holland Kust Stad bij Alphen aan den Rijn")], "doc_id int, clean_geo string")
    linked = ["den haag", "haag zuid", "zuid holland", "holland kust", "kust stad", "alphen aan den rijn", "rijn"]
    known = spark.createDataFrame([(n, "NL") for n in linked], "name_lower string, cc string")
    found = pc.location_mentions(chain, known).orderBy("pos").collect()
    assert [r.loc for r in found] == ["Den Haag", "Zuid Holland", "Kust Stad", "Alphen aan den Rijn"]
    assert [r.loc for r in pc.location_mentions(chain, known, max_words=1).collect()] == ["Rijn"]
    blocked = pc.location_mentions(df, lookup, blocked=["Nederland"])
    assert "Nederland" not in [r.loc for r in blocked.collect()]
    own = pc.location_mentions(df, lookup, candidates=lambda d: d.select("doc_id", F.lit(0).alias("pos"), F.lit("HAAG").alias("loc")))
    assert [r.loc for r in own.collect()] == ["HAAG"]


# --- rules and label model ------------------------------------------------------

HITS = {
    "lf_explicit_sme": ["het mkb klaagt", "midden- en kleinbedrijf", "een mkb'er", "mkb-ondernemer"],
    "lf_generic_bedrijf": ["kleine  bedrijf", "bedrijffen", "organisaties in de regio", "een zaak"],
    "lf_general_sector_terms": ["een café.", "e-commerce groeit", "financiële dienstverlening", "bakkerij"],
    "lf_generic_entrepreneurship": ["start-up", "startup", "bedrijf starten", "zzp"],
    "lf_international_politics": ["de v.n. zegt", "oorlog"],
    "lf_accidents_crime": ["brand!"],
    "lf_politics_domestic": ["de gemeente"],
    "lf_sme_cybercrime": ["ondernemer en ransomware"],
    "lf_sports_entertainment": ["voetbal"],
    "lf_business_crime": ["bedrijf: onderzoek  naar lek", "mkb en fraude"],
    "lf_bankruptcy_only": ["curator aangesteld"],
    "lf_government_only": ["nieuwe  positie", "carrière"],
}
MISSES = {
    "lf_explicit_sme": ["mkbx", "émkb"],
    "lf_generic_bedrijf": ["bedrijfé", "rechtszaak"],
    "lf_general_sector_terms": ["cafés", "ébar", "bit", "bank_x"],
    "lf_generic_entrepreneurship": ["startend"],
    "lf_international_politics": ["europese"],
    "lf_accidents_crime": ["brandweer"],
    "lf_politics_domestic": ["gemeentehuis"],
    "lf_sme_cybercrime": ["ondernemer", "ransomware"],
    "lf_sports_entertainment": ["voetballer"],
    "lf_business_crime": ["fraude", "bedrijf"],
    "lf_bankruptcy_only": ["curator en fraude"],
    "lf_government_only": ["ministeries"],
}


def test_dutch_rules(spark):
    import dataclasses

    everything = [dataclasses.replace(r, active=True) for r in RULES]
    assert {r.name for r in everything} == set(HITS)
    assert sorted(r.name for r in RULES if not r.active) == ["lf_bankruptcy_only", "lf_international_politics"]
    cases = [(n, t, True) for n, ts in HITS.items() for t in ts] + [(n, t, False) for n, ts in MISSES.items() for t in ts]
    df = spark.createDataFrame([(n, t.upper() if i % 2 else t, h) for i, (n, t, h) in enumerate(cases)], "rule string, clean_geo string, hit boolean")
    vote_of = {r.name: r.vote for r in RULES}
    for r in ru.apply_rules(df, everything).collect():
        assert r[r.rule] == (vote_of[r.rule] if r.hit else ru.ABSTAIN), (r.rule, r.clean_geo)
    blank = spark.createDataFrame([(None,), ("",)], "clean_geo string")
    assert all(v == -1 for r in ru.apply_rules(blank, everything).collect() for v in r[1:])


def test_rule_patterns_agree_with_word_sets(spark):
    """Plain words through the word set and through a pattern give the same votes."""
    terms = ("bar", "café", "it", "x_1")
    texts = ["bar", "ébar", "a bar.", "café", "cafés", "it's", "bit", "x_1", "x_12", "IT", "", "bar_", "[bar]"]
    df = spark.createDataFrame([(t,) for t in texts], "clean_geo string")
    pattern = ru.ColumnRule("pattern", lambda c: F.when(c.rlike(ru.bounded_pattern(terms)), ru.SME), (ru.SME,))
    got = ru.apply_rules(df, [ru.Rule("words", ru.SME, (terms,)), pattern]).collect()
    assert [r.words for r in got] == [r.pattern for r in got]


def synthetic_votes(spark, n=4000, seed=3):
    rng = np.random.default_rng(seed)
    truth = rng.random(n) < 0.5
    data = {}
    for name, vote, accuracy, coverage in [("a", 1, 0.9, 0.6), ("b", 1, 0.7, 0.5), ("c", 0, 0.85, 0.6), ("d", 0, 0.75, 0.4)]:
        match = truth == bool(vote)
        fires = rng.random(n) < np.where(match, coverage * accuracy, coverage * (1 - accuracy)) * 1.0
        data[name] = np.where(fires, vote, -1)
    rows_ = [(i, int(truth[i]), *[int(data[k][i]) for k in "abcd"]) for i in range(n)]
    rules = [ru.ColumnRule(k, lambda c: c, (v,)) for k, v in zip("abcd", (1, 1, 0, 0))]
    return spark.createDataFrame(rows_, "id int, truth int, a int, b int, c int, d int"), rules


def test_vote_statistics(spark):
    votes, rules = synthetic_votes(spark)
    local = votes.toPandas()
    for r in ru.rule_coverage(votes, rules).collect():
        assert r.coverage == pytest.approx((local[r.rule] != -1).mean())
        assert r.coverage == pytest.approx(r.sme + r.not_sme)
    for r in ru.vote_moments(votes, rules).collect():
        assert r.share == pytest.approx(((local[r.rule_a] == r.vote_a) & (local[r.rule_b] == r.vote_b)).mean())


def test_label_model(spark):
    votes, rules = synthetic_votes(spark)
    model = lm.fit_label_model(votes, rules)
    assert model == lm.fit_label_model(votes.repartition(5), rules)
    weights = {r: w for r, _, w in model.weights}
    assert weights["a"] > 0 and weights["b"] > 0 and weights["c"] < 0 and weights["d"] < 0
    scored = lm.label(votes, model, 0.5).toPandas()
    silent = scored[(scored[["a", "b", "c", "d"]] == -1).all(axis=1)]
    assert np.allclose(silent.sme_probability, 0.5) and (silent.sme_label == 1).all()
    spoken = scored.drop(silent.index)
    assert (spoken.sme_label == spoken.truth).mean() > 0.75
    majority = votes.select("id", ru.majority_vote(rules).alias("m")).toPandas().set_index("id").m
    for pattern, group in spoken.groupby(["a", "b", "c", "d"]):
        said = {v for v in pattern if v != -1}
        if len(said) == 1:
            assert (group.sme_label == said.pop()).all()
            assert (majority[group.id] == group.sme_label.values).all()
    # adding a positive vote never lowers the probability
    probability = {p: g.sme_probability.iloc[0] for p, g in scored.groupby(["a", "b", "c", "d"])}
    for a, b, c, d in itertools.product((-1, 1), (-1, 1), (-1, 0), (-1, 0)):
        if b == -1 and (a, 1, c, d) in probability and (a, b, c, d) in probability:
            assert probability[(a, 1, c, d)] >= probability[(a, b, c, d)]


def test_label_model_is_symmetric():
    shares = np.array([[0.4, 0.2, 0.1], [0.2, 0.3, 0.05], [0.1, 0.05, 0.35]])
    mu = lm.fit_vote_probabilities(shares, [1, 1, 0], list("abc"), 1000)
    swapped = lm.fit_vote_probabilities(shares, [0, 0, 1], list("abc"), 1000)
    assert np.allclose(mu, swapped[:, ::-1])


# --- filters --------------------------------------------------------------------


def articles(spark):
    return spark.createDataFrame(
        [
            (1, "alpha", "Brand in Sittard", ["Sittard"], "2025-01-02 10:00:00", 0.9, [("brand", 0.5)]),
            (2, "alpha", "Markt (open)", ["Den Haag", "Berg"], "2025-01-03 23:59:59", 0.8, [("markt", 0.4), ("brand", 0.2)]),
            (3, None, "Niets", None, None, None, None),
            (4, "beta", "BRAND", [], "2025-02-01 00:00:00", 0.1, []),
        ],
        "doc_id int, feed string, title string, locations array<string>, ts string, sme_probability double, "
        "keywords array<struct<word:string,score:double>>",
    ).withColumn("published_ts", F.col("ts").cast("timestamp")).drop("ts")


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_text_search(spark):
    df = articles(spark)
    assert ids(df.where(fl.text_matches(df.schema, "brand"))) == [1, 2, 4]
    assert ids(df.where(fl.text_matches(df.schema, "(open)"))) == [2]
    assert ids(df.where(fl.text_matches(df.schema, "^(mar|nie)", literal=False))) == [2, 3]
    assert ids(df.where(fl.text_matches(df.schema, "none"))) == []
    quoted = spark.createDataFrame([(1, ['say x "y" now']), (2, None), (3, ["xy", None])], "doc_id int, tags array<string>")
    assert ids(quoted.where(fl.text_matches(quoted.schema, 'x "y"'))) == [1]


def test_other_filters(spark):
    df = articles(spark)
    assert ids(df.where(fl.feed_in(["alpha"]))) == [1, 2]
    assert ids(df.where(fl.feed_in([]))) == []
    assert ids(df.where(fl.location_tags("SITT, haag"))) == [1, 2]
    assert ids(df.where(fl.location_tags(" , "))) == [1, 2, 3, 4]
    assert ids(df.where(fl.date_between("published_ts", "2025-01-02", "2025-01-03"))) == [1, 2]
    assert ids(df.where(fl.since("published_ts", "2025-01-03"))) == [2, 4]


def test_filters_reach_the_scan(spark, tmp_path):
    articles(spark).write.parquet(f"{tmp_path}/a")
    df = spark.read.parquet(f"{tmp_path}/a").select("doc_id", "feed", "published_ts")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    assert "In(feed, [alpha,beta])" in plan(df.where(fl.feed_in(["alpha", "beta"])))
    dated = plan(df.where(fl.date_between("published_ts", "2025-01-02", "2025-01-03")))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(published_ts" in dated and "LessThan(published_ts" in dated


@pytest.mark.parametrize(
    "start,end,want",
    [
        ("2025-01-03", "2025-01-10", ("2025-01-03", "2025-01-10")),
        ("2000-01-01", "2100-01-01", ("2025-01-02", "2025-02-01")),
        ("2025-01-10", "2025-01-03", ("2025-01-02", "2025-02-01")),
        ("soon", "2025-01-03", ("2025-01-02", "2025-02-01")),
        ("2100-01-01", "2101-01-01", ("2025-02-01", "2025-02-01")),
        (None, None, ("2025-01-02", "2025-02-01")),
    ],
)
def test_clamp(spark, start, end, want):
    got = fl.clamp_range(fl.date_bounds(articles(spark)), start, end).first()
    assert (str(got.start_d), str(got.end_d)) == want


def test_specs_and_presets(spark):
    df = articles(spark)
    spec = fl.FilterSpec.from_mapping({"text_filter": "brand", "selected_feeds": ["alpha"], "date_range": ["2025-01-01", "2025-01-02"]})
    assert ids(fl.apply_filters(df, spec)) == [1]
    # undated articles are never shown, unless they are asked for
    assert ids(fl.apply_filters(df, fl.FilterSpec.from_mapping({}))) == [1, 2, 4]
    assert ids(fl.apply_filters(df, fl.FilterSpec(undated=True))) == [1, 2, 3, 4]
    assert ids(fl.apply_filters(df, fl.FilterSpec(date_range=("2100-01-01", "2101-01-01")))) == [4]
    tagged = fl.tag_presets(df, {"fire": fl.FilterSpec(text_filter="brand"), "alpha": fl.FilterSpec(selected_feeds=("alpha",))})
    assert rows(tagged, "preset", "doc_id") == [("alpha", 1), ("alpha", 2), ("fire", 1), ("fire", 2), ("fire", 4)]
    assert "Join" not in plan(tagged)
    specs = {
        str(i): fl.FilterSpec(date_range=span, undated=undated, selected_feeds=feeds)
        for i, (span, undated, feeds) in enumerate(
            (s, u, f)
            for s in (None, ("2025-01-03", "2025-01-10"), ("2100-01-01", "2101-01-01"), ("2025-02-01", "2025-01-01"), ("soon", "2025-01-02"))
            for u in (False, True) for f in (None, ("alpha",)))
    }
    together = rows(fl.tag_presets(df, specs), "preset", "doc_id")
    assert together == sorted((name, i) for name, spec in specs.items() for i in ids(fl.apply_filters(df, spec)))
    one, two = fl.text_matches(df.schema, "brand"), fl.feed_in(["alpha"])
    assert ids(df.where(one).where(two)) == ids(df.where(two).where(one))
    kept = {r.stage: (r.kept, r.total) for r in fl.keep_ratio(df, {"alpha": F.col("feed") == "alpha"}).collect()}
    assert kept == {"alpha": (2, 4)}


# --- exploration ------------------------------------------------------------------


def test_names_of_any_length_from_first_words(spark):
    long_name = "san pedro de la sierra alta del rio grande de los santos"
    names = [(long_name, "ES"), ("san", "NL"), ("san pedro", "BE"), ("de la", "BE"), ("los santos", "DE"), ("i\u0307stanbul", "DE")]
    lookup = spark.createDataFrame(names, "name_lower string, cc string")
    whole = "San Pedro De La Sierra Alta del Rio Grande de Los Santos"
    texts = [(1, whole), (2, "In San Pedro De La Sierra Los Santos"), (3, "San San Pedro"), (4, "\u0130stanbul"), (5, "san pedro"), (6, None), (7, "")]
    df = spark.createDataFrame(texts, "doc_id int, clean_geo string")
    got = {}
    for r in pc.location_mentions(df, lookup).orderBy("doc_id", "pos").collect():
        got.setdefault(r.doc_id, []).append((r.loc, r.cc))
    assert got == {
        1: [(whole, "ES")],
        2: [("San Pedro", "BE"), ("De La", "BE"), ("Los Santos", "DE")],
        3: [("San", "NL"), ("San Pedro", "BE")],
        4: [("\u0130stanbul", "DE")],
    }
    # never more rows than names that may begin at a token, and the same as trying every length
    spans = pc.known_spans(df, lookup)
    tried = pc.match_mentions(pc.candidate_spans(df, max_words=12), lookup)
    assert sorted(map(tuple, tried.collect())) == sorted(map(tuple, pc.left_to_right(spans).collect()))
    assert sorted((r["first"], r.lengths) for r in pc.name_starts(pc.named_words(lookup)).collect()) == [
        ("de", [2]), ("i\u0307stanbul", [1]), ("los", [2]), ("san", [1, 2, 12])]


def test_mentions_against_a_plain_walk(spark):
    import random

    rnd = random.Random(4)
    words = ["A", "B", "C", "d"]
    names = {" ".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 5))) for _ in range(25)}
    texts = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))) for i in range(60)] + [(99, "A " * 3000)]

    def walk(text):
        tokens, found, until = text.split(), [], 0
        for i, t in enumerate(tokens):
            if i >= until and t.isupper():
                known = [n for n in range(1, 6) if i + n <= len(tokens) and " ".join(tokens[i : i + n]).lower() in names]
                if known:
                    found.append((i + 1, " ".join(tokens[i : i + max(known)])))
                    until = i + max(known)
        return found

    df = spark.createDataFrame(texts, "doc_id int, clean_geo string").repartition(3)
    lookup = spark.createDataFrame([(n, "NL") for n in names], "name_lower string, cc string")
    got = sorted((r.doc_id, r.pos, r["loc"]) for r in pc.location_mentions(df, lookup).collect())
    assert got == sorted((i, p, loc) for i, t in texts for p, loc in walk(t))


def test_location_aggregates(spark):
    df = spark.createDataFrame(
        [(1, "t1", ["A", "A", "b"]), (2, None, ["A"]), (3, "t3", None)], "doc_id int, title string, locations array<string>")
    at = spark.createDataFrame([("A", 1.0, 2.0), ("B", 3.0, 4.0)], "location string, lat double, lon double")
    mentions = ex.located_mentions(df, at)
    assert rows(ex.location_weights(mentions), "location", "weight") == [("A", 3)]
    assert rows(ex.location_titles(mentions), "title", "mentions") == [("Untitled Article", 1), ("t1", 2)]


@pytest.mark.parametrize("max_values", [None, 0])
def test_region_flag_both_ways(spark, max_values):
    region = spark.createDataFrame([("sittard",), ("berg",)], "name_lower string")
    flagged = ex.flag_region(articles(spark), region, max_values=max_values)
    assert rows(flagged, "doc_id", "in_region") == [(1, True), (2, True), (3, False), (4, False)]


def test_spotlight(spark):
    region = spark.createDataFrame([("berg",)], "name_lower string")
    assert rows(ex.spotlight(articles(spark), region, 2), "doc_id", "reason") == [(1, "probability"), (2, "region+probability")]
    assert ids(ex.top_probability(articles(spark), 4)) == [1, 2, 3, 4]


def test_listing_rows(spark):
    html = (
        "<div class='item'><i>21-10-2025</i><a href='/a/1'>One &amp; two</a></div>"
        "<div class='item'><a href='/a/2'>No date</a></div>"
        "<div class='item'><i>99-99-2025</i><a href='/a/3'>Bad date</a></div>"
        "<div class='item'><i>05-10-2025</i>No link</div>"
    )
    pages = spark.createDataFrame([("https://a.example/list", html)], "url string, html string")
    got = listing_rows(
        pages, r"(?is)<div class='item'>(.*?)</div>",
        {"date": "<i>(.*?)</i>", "title": r"<a[^>]*>(.*?)</a>", "href": r"<a href='([^']*)'"}, ["dd-MM-yyyy"])
    assert rows(got, "item_no", "title", "href") == [(0, "One & two", "https://a.example/a/1"), (3, "", "")]


def test_triplets_agree_with_the_truth_and_with_the_steps():
    from newsloom.operators import label_model as lm

    rng = np.random.default_rng(2)
    n = 200_000
    truth = rng.random(n) < 0.5
    own = {"a": (1, 0.6, 0.1), "b": (0, 0.5, 0.15), "c": (1, 0.4, 0.05), "d": (0, 0.7, 0.3), "e": (1, 0.3, 0.1)}  # vote, P under its class, under the other
    fired = np.array([np.where(truth == bool(v), rng.random(n) < p, rng.random(n) < q) for v, p, q in own.values()], float)
    shares = fired @ fired.T / n
    votes, owners = [v for v, _, _ in own.values()], list(own)
    closed = lm.triplet_vote_probabilities(shares, votes, owners, n)
    stepped = lm.fit_vote_probabilities(shares, votes, owners, n, epochs=4000)
    for i, (v, p, q) in enumerate(own.values()):
        assert closed[i, v] == pytest.approx(p, abs=0.02) and closed[i, 1 - v] == pytest.approx(q, abs=0.02)
        assert closed[i].tolist() == pytest.approx(stepped[i].tolist(), abs=0.05)
    # a vote that no pair of others speaks about says nothing
    alone = lm.triplet_vote_probabilities(np.diag([0.5, 0.2]), [1, 0], ["a", "b"], n)
    assert alone.tolist() == [[0.5, 0.5], [0.2, 0.2]]
