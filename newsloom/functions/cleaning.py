"""Text cleaning and tokenising.

All steps are built-in expressions except two that have no built-in: Unicode
compatibility normalisation and splitting of run-together tags. Both receive
only the values that need them (null otherwise), so ordinary text never
crosses to a Python worker.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from newsloom.functions.markup import html_to_text
from newsloom.functions.strings import _col, blank_to_empty, interleave
from newsloom.rules.stopwords import DUTCH

# Workers need not have this package installed: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Both classes list what they look for instead of negating what they keep:
# the negated form of several ranges is several times slower in Java.

# Characters that compatibility normalisation may change or combine. Text
# without them needs no Python.
UNSTABLE = (
    r"[\xA0\xA8\xAA\xAF\xB2-\xB5\xB8-\xBA\xBC-\xBE\x{132}\x{133}\x{13F}\x{140}\x{149}"
    r"\x{17F}-\x{200F}\x{2011}\x{2017}\x{2024}-\x{2038}\x{203B}-\x{20AB}\x{20AD}-\x{10FFFF}]"
)
# Everything outside ASCII and the accented Latin-1 letters: a quick first test.
UNUSUAL = r"[\x80-\xBF\x{100}-\x{10FFFF}]"
# Everything but 0-9, A-Z, a-z and U+00C0..U+00FF.
NOT_CLEAN = r"[\x00-/:-@\[-`{-\xBF\x{100}-\x{10FFFF}]"
WORD = r"[\p{L}\p{N}_]"


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def nfkc(c: Column | str) -> Column:
    text = _col(c)
    return F.coalesce(_nfkc(F.when(text.rlike(UNUSUAL) & text.rlike(UNSTABLE), text)), text)


def strip_number_header(c: Column | str) -> Column:
    """Drop a leading episode number such as ``#12 - ``."""
    # fixed value: the form of such a number
    return F.regexp_replace(_col(c), r"^\s*#?\d+\s*[-–—:]\s*", "")


def tags_to_blank(c: Column | str) -> Column:
    return F.translate(_col(c), "@#", "  ")


def punct_to_space(c: Column | str) -> Column:
    """Blank for every character that is not a plain or accented Latin letter or a digit."""
    return F.regexp_replace(_col(c), NOT_CLEAN, " ")


def collapse_lower(c: Column | str) -> Column:
    return F.lower(F.trim(F.regexp_replace(_col(c), r"\s+", " ")))


def letters_only(c: Column | str) -> Column:
    """Tag symbols and punctuation to blanks, blanks collapsed, lower case.

    One pass: tag symbols and whitespace are among what is not a letter.
    """
    return F.lower(F.trim(F.regexp_replace(_col(c), NOT_CLEAN + "+", " ")))


def clean_text_geo(c: Column | str, normalize: bool = True) -> Column:
    """Markup and compatibility characters out, casing and punctuation kept."""
    text = html_to_text(blank_to_empty(c))
    return nfkc(text) if normalize else text


def clean_text(c: Column | str, normalize: bool = True, tag_costs: dict[str, float] | None = None) -> Column:
    """Lower-cased words separated by single blanks.

    With ``tag_costs`` (see ``word_costs``) run-together tags are split into
    words; without it a tag keeps its text and loses its symbol.
    """
    text = strip_number_header(clean_text_geo(c, normalize))
    if tag_costs is not None:
        text = split_tags(text, tag_costs)
    return letters_only(text)


def with_clean_geo(df: DataFrame, text: Column | str, name: str = "clean_geo", normalize: bool = True) -> DataFrame:
    """``clean_text_geo`` as a column. The steps are separate projections, so the
    text that normalisation tests, converts and falls back to is made once."""
    out = df.withColumn(name, html_to_text(blank_to_empty(text)))
    return out.withColumn(name, nfkc(name)) if normalize else out


def with_clean(
    df: DataFrame,
    text: Column | str,
    name: str = "clean",
    normalize: bool = True,
    tag_costs: dict[str, float] | None = None,
) -> DataFrame:
    """``clean_text`` as a column, in the same way."""
    out = with_clean_geo(df, text, name, normalize).withColumn(name, strip_number_header(name))
    if tag_costs is not None:
        out = out.withColumn(name, split_tags(name, tag_costs))
    return out.withColumn(name, letters_only(name))


# --- tags -------------------------------------------------------------------

# Fixed value: what counts as a tag.
TAG_MARK = r"(?U)[@#](\w+)"


def word_costs(ranked_words: list[str]) -> dict[str, float]:
    """Cost of each word, from its frequency rank under Zipf's law."""
    size = max(len(ranked_words), 2)
    return {w: math.log((rank + 1) * math.log(size)) for rank, w in enumerate(ranked_words)}


def segment(run: str, costs: dict[str, float], longest: int) -> list[str]:
    """Cheapest split of a run of letters into known words.

    A stretch no word covers costs a flat amount plus some per character, so
    it stays in one piece instead of falling apart into letters.
    """
    low = run.lower()
    opening, per_char = 12.0, 8.0
    known = [0.0] + [math.inf] * len(low)      # best cost, last piece a word
    unknown = [math.inf] * (len(low) + 1)      # best cost, last piece unknown
    word_from = [0] * (len(low) + 1)
    gap_from = [0] * (len(low) + 1)
    for end in range(1, len(low) + 1):
        for start in range(max(0, end - longest), end):
            cost = costs.get(low[start:end])
            if cost is not None and min(known[start], unknown[start]) + cost < known[end]:
                known[end] = min(known[start], unknown[start]) + cost
                word_from[end] = start
        opened, extended = known[end - 1] + opening, unknown[end - 1]
        unknown[end] = min(opened, extended) + per_char
        gap_from[end] = end - 1 if opened <= extended else gap_from[end - 1]
    pieces, end = [], len(low)
    while end > 0:
        start = word_from[end] if known[end] <= unknown[end] else gap_from[end]
        pieces.append(run[start:end])
        if known[end] > unknown[end]:
            # an unknown stretch is always preceded by a known word or the start
            end = start
            if end > 0:
                pieces.append(run[word_from[end]:end])
                end = word_from[end]
        else:
            end = start
    return pieces[::-1]


CAMEL = re.compile(r"[0-9]+|[^\W\d_]+", re.UNICODE)


def split_tag(tag: str, costs: dict[str, float], longest: int) -> str:
    words: list[str] = []
    for run in CAMEL.findall(tag):
        if run.isdigit():
            words.append(run)
            continue
        cut = re.sub(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ])", " ", run).split()
        for part in cut:
            words.extend(segment(part, costs, longest))
    return " ".join(words)


def split_tags(c: Column | str, costs: dict[str, float]) -> Column:
    """Replace ``@name`` and ``#tag`` by their words, in place.

    Only the tags themselves reach Python, as a short array per row; repeated
    tags are split once per task, up to the size of the cache.
    """
    text = _col(c)
    longest = max(map(len, costs), default=1)

    @F.pandas_udf(ArrayType(StringType()))
    def words_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cached = lru_cache(maxsize=100_000)(lambda t: split_tag(t, costs, longest))
        for tags in batches:
            yield tags.map(lambda ts: [cached(t) for t in ts], na_action="ignore")

    tagged = text.rlike(TAG_MARK)
    words = words_of(F.when(tagged, F.regexp_extract_all(text, F.lit(TAG_MARK), 1)))
    return F.when(tagged, interleave(F.split(text, TAG_MARK, -1), words)).otherwise(text)


# --- tokens -----------------------------------------------------------------


def ws_tokens(clean: Column | str) -> Column:
    return F.filter(F.split(_col(clean), r"\s+", -1), lambda t: t != "")


def word_tokens(c: Column | str) -> Column:
    """Lower-cased tokens of at least two word characters, from any text."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(rf"({WORD}{{2,}})"), 1)


def clean_word_tokens(clean: Column | str) -> Column:
    """``word_tokens`` for text that ``clean_text`` made; a plain split suffices.

    Of what the cleaned alphabet holds only the two arithmetic signs are not
    word characters.
    """
    return F.filter(F.split(F.translate(_col(clean), "×÷", "  "), " ", -1), lambda t: F.length(t) >= 2)


def drop_stopwords(tokens: Column | str, stopwords: list[str]) -> Column:
    """Remove stop words; repeats of the other tokens stay."""
    if not stopwords:
        return _col(tokens)
    return F.filter(_col(tokens), lambda t: ~t.isin(*stopwords))


def stopwords(language: str = "dutch") -> list[str]:
    if language == "dutch":
        return list(DUTCH)
    from pyspark.ml.feature import StopWordsRemover

    return list(StopWordsRemover.loadDefaultStopWords(language))
