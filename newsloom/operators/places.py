"""Place mentions in articles and the country vote over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.strings import let
from newsloom.operators.gazetteer import COUNTRIES
from newsloom.operators.lookup import fits_broadcast, lookup_join
from newsloom.operators.rows import explode_rows
from newsloom.sources.staging import stage

NAME_TOKEN = r"'?[\p{L}\p{N}](?:[\p{L}\p{N}'\-]*[\p{L}\p{N}])?"
STARTS_NAME = r"^(?:'\p{L}-)?\p{Lu}"
VOTE_THRESHOLD = 0.6
UNCERTAIN = "uncertain"


def _starts_name(token: Column) -> Column:
    """Whether a token begins as names do; most tokens begin with a plain small letter and need no pattern."""
    return ~((token >= "a") & (token < "{")) & token.rlike(STARTS_NAME)


def candidate_spans(df: DataFrame, text: str = "clean_geo", id_col: str = "doc_id", max_words: int = 3) -> DataFrame:
    """(id, pos, words, loc): runs of 1..max_words tokens that start with a capital."""
    tokens = df.select(id_col, F.regexp_extract_all(F.col(text), F.lit(NAME_TOKEN), 0).alias("w"))

    def spans(w: Column) -> Column:
        starts = F.filter(
            F.transform(w, lambda t, i: F.when(_starts_name(t), i + 1)), lambda i: i.isNotNull()
        )
        return F.flatten(F.transform(
            starts,
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(max_words), F.size(w) - i + 1)),
                lambda n: F.struct(i.alias("pos"), n.alias("words"), F.array_join(F.slice(w, i, n), " ").alias("loc")),
            ),
        ))

    each = explode_rows(tokens, let(F.col("w"), spans), "s", [id_col])
    return each.select(id_col, "s.pos", "s.words", "s.loc")


def named_words(lookup: DataFrame, name: str = "name_lower") -> DataFrame:
    """The lookup with the first word of each name and its number of words."""
    words = F.length(name) - F.length(F.replace(F.col(name), F.lit(" "))) + 1
    return lookup.select(F.col(name).alias("name_lower"), "cc", F.substring_index(name, " ", 1).alias("first"), words.alias("words"))


def name_starts(names: DataFrame) -> DataFrame:
    """(first, lengths): for every word that begins a name, in how many words such names come.

    The root of a phrase automaton: one row per first word, with no more
    lengths than the longest name has words.
    """
    return names.groupBy("first").agg(F.array_sort(F.collect_set("words")).alias("lengths"))


def known_spans(
    df: DataFrame,
    lookup: DataFrame,
    text: str = "clean_geo",
    id_col: str = "doc_id",
    max_words: int | None = None,
    blocked: list[str] | None = None,
) -> DataFrame:
    """(id, pos, words, loc, cc): every run of tokens with a capital first that is a name of the lookup.

    A token goes on only if a name begins with it, and then gives one row per
    length of such names, so there are never more rows than names that may
    begin there. The names are measured before they are joined; their first
    words are fewer and smaller.
    """
    names = stage(named_words(lookup), "lookup")
    starts, fits = name_starts(names), fits_broadcast(names)
    longest = names.agg(F.max("words")).first()[0] or 1
    reach = min(longest, max_words) if max_words else longest
    tokens = df.select(id_col, F.regexp_extract_all(F.col(text), F.lit(NAME_TOKEN), 0).alias("w"))

    def capitals(w: Column) -> Column:
        found = F.transform(w, lambda t, i: F.when(_starts_name(t), F.struct((i + 1).alias("pos"), F.slice(w, i + 1, F.lit(reach)).alias("ahead"))))
        return F.filter(found, lambda s: s.isNotNull())

    each = explode_rows(tokens, let(F.col("w"), capitals), "s", [id_col])
    first = each.select(id_col, "s.pos", "s.ahead", F.lower(F.get("s.ahead", F.lit(0))).alias("first"))
    begun = lookup_join(first, starts, "first", spread_by=[id_col, "pos"], fits=fits)
    lengths = F.filter("lengths", lambda n: n <= F.size("ahead"))
    spans = explode_rows(begun, lengths, "words", [id_col, "pos", "ahead"])
    named = spans.select(id_col, "pos", "words", F.array_join(F.slice("ahead", F.lit(1), F.col("words")), " ").alias("loc"))
    return _looked_up(named, names.select("name_lower", "cc"), id_col, blocked, fits)


def _looked_up(candidates: DataFrame, lookup: DataFrame, id_col: str, blocked: list[str] | None, fits: bool | None = None) -> DataFrame:
    keyed = candidates.withColumn("name_lower", F.lower("loc"))
    if blocked:
        keyed = keyed.where(~F.col("name_lower").isin(*[b.lower() for b in blocked]))
    return lookup_join(keyed, lookup, "name_lower", spread_by=[id_col, "pos"], fits=fits).select(id_col, "pos", "words", "loc", "cc")


def match_mentions(
    candidates: DataFrame,
    lookup: DataFrame,
    id_col: str = "doc_id",
    blocked: list[str] | None = None,
) -> DataFrame:
    """Candidates (id, pos, words, loc) the lookup knows, chosen by ``left_to_right``."""
    return left_to_right(_looked_up(candidates, lookup, id_col, blocked), id_col)


def left_to_right(known: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, pos, loc, cc): known names from left to right, longest first, without overlaps.

    At each position the longest known name counts. A name that begins inside
    an earlier one that was kept is part of it and is dropped; one that begins
    inside a dropped name is not. The names of an article meet in its row, one
    shuffle of what is known, and are walked there.
    """
    rows = known.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "words", "loc", "cc"))).alias("s"))
    # the longest of each position is the last one, as they are sorted by position and words
    longest = F.filter("s", lambda x, i: F.coalesce(F.get("s", i + 1)["pos"] != x["pos"], F.lit(True)))
    return explode_rows(rows.select(id_col, let(longest, _walk).alias("s")), "s", "m", [id_col]).select(id_col, "m.pos", "m.loc", "m.cc")


def _walk(spans: Column) -> Column:
    """Spans in order, without those that begin before the last kept one ends.

    The walk runs chain by chain: where no earlier name reaches, it starts
    anew. A name overlaps those before it only as far back as names have words.
    """
    back = F.aggregate(spans, F.lit(1), lambda most, s: F.greatest(most, s["words"]))

    def chains(reach: Column) -> Column:
        def begins(s: Column, i: Column) -> Column:
            before = F.slice(spans, F.greatest(i + 2 - reach, F.lit(1)), F.least(i, reach - 1))
            return F.when(~F.exists(before, lambda b: b["pos"] + b["words"] > s["pos"]), i + 1)

        heads = F.filter(F.transform(spans, begins), lambda i: i.isNotNull())
        return let(heads, lambda h: F.transform(h, lambda at, k: F.slice(spans, at, F.coalesce(F.get(h, k + 1), F.size(spans) + 1) - at)))

    return F.flatten(F.transform(let(back, chains), _kept))


def _kept(chain: Column) -> Column:
    def step(kept: Column, s: Column) -> Column:
        last = F.get(kept, F.size(kept) - 1)
        return F.when(last["pos"] + last["words"] <= s["pos"], F.concat(kept, F.array(s))).otherwise(kept)

    return F.when(F.size(chain) == 1, chain).otherwise(F.aggregate(F.slice(chain, 2, F.size(chain)), F.slice(chain, 1, 1), step))


def location_mentions(
    df: DataFrame,
    lookup: DataFrame,
    text: str = "clean_geo",
    id_col: str = "doc_id",
    candidates: Callable[[DataFrame], DataFrame] | None = None,
    blocked: list[str] | None = None,
    max_words: int | None = None,
) -> DataFrame:
    """(id, pos, loc, cc) per place mention.

    Names may have as many words as the longest one of the lookup, unless
    ``max_words`` says otherwise. ``candidates`` may bring a recogniser of
    one's own: it gets the articles and returns (id, pos, loc) rows, which are
    then only looked up; those the lookup does not know stay, without a country.
    """
    if candidates is None:
        return left_to_right(known_spans(df, lookup, text, id_col, max_words, blocked), id_col)
    lookup = stage(lookup.select("name_lower", "cc"), "lookup")
    return lookup_mentions(candidates(df), lookup, id_col)


def lookup_mentions(mentions: DataFrame, lookup: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Equi lookup of lower-cased mentions; those without an entry keep their place and have no country."""
    keyed = mentions.withColumn("name_lower", F.lower("loc"))
    return lookup_join(keyed, lookup, "name_lower", "left", spread_by=[id_col, "pos"]).select(id_col, "pos", "loc", "cc")


def explode_locations(df: DataFrame, locations: str = "locations", id_col: str = "doc_id") -> DataFrame:
    """(id, pos, loc), one row per mention."""
    return explode_rows(df, locations, "loc", [id_col], pos="pos")


def evidence(countries: tuple[str, ...] = COUNTRIES) -> Column:
    """Ordered (loc, cc) pairs of the mentions that may vote; bounded by the article."""
    hit = F.when(F.col("cc").isin(*countries), F.struct("pos", "loc", "cc"))
    ordered = F.array_sort(F.collect_list(hit))
    return F.transform(ordered, lambda e: F.struct(e["loc"].alias("loc"), e["cc"].alias("cc")))


def vote_counts(mentions: DataFrame, id_col: str = "doc_id", countries: tuple[str, ...] = COUNTRIES) -> DataFrame:
    """Mentions per country and article; repeated mentions count again."""
    return mentions.groupBy(id_col).agg(
        *[F.count_if(F.col("cc") == c).alias(f"votes_{c.lower()}") for c in countries]
    )


def pick_winner(
    votes: DataFrame, threshold: float = VOTE_THRESHOLD, countries: tuple[str, ...] = COUNTRIES
) -> DataFrame:
    """Adds country and country_score from the ``votes_*`` columns.

    The score is the winner's share. Ties go to the country listed first; a
    share below the threshold is uncertain but keeps its score; no vote at all
    is uncertain with score 0.
    """
    counts = [F.coalesce(F.col(f"votes_{c.lower()}"), F.lit(0)) for c in countries]
    total = sum(counts[1:], counts[0])
    best = F.greatest(*counts)
    winner = F.coalesce(*[F.when(n == best, F.lit(c)) for c, n in zip(countries, counts)])
    score = F.coalesce(F.try_divide(best.cast("double"), total.cast("double")), F.lit(0.0))
    return votes.withColumn("country_score", score).withColumn(
        "country",
        F.when((total == 0) | (F.col("country_score") < threshold), F.lit(UNCERTAIN)).otherwise(winner),
    )


def vote_countries(
    mentions: DataFrame,
    id_col: str = "doc_id",
    threshold: float = VOTE_THRESHOLD,
    countries: tuple[str, ...] = COUNTRIES,
) -> DataFrame:
    """(id, locations, country, country_score, country_evidence) per article with mentions."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "loc")))
    grouped = mentions.groupBy(id_col).agg(
        F.transform(ordered, lambda m: m["loc"]).alias("locations"),
        *[F.count_if(F.col("cc") == c).alias(f"votes_{c.lower()}") for c in countries],
        evidence(countries).alias("country_evidence"),
    )
    return pick_winner(grouped, threshold, countries).drop(*[f"votes_{c.lower()}" for c in countries])


def country_filter(df: DataFrame, min_conf: float = 0.6, countries: tuple[str, ...] = COUNTRIES) -> DataFrame:
    """Rows resolved to a target country with enough confidence."""
    missing = {"country", "country_score"} - set(df.columns)
    if missing:
        raise ValueError(f"country filter needs columns {sorted(missing)}")
    return df.where(F.col("country").isin(*countries) & (F.col("country_score") >= min_conf))
