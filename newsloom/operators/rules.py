"""Keyword rules as data, compiled to vote columns, and their vote statistics.

A rule looks for terms between word boundaries in lower-cased text. Terms are
written out into the word sequences they match. The words of a text are met
with all of those words once per row, for all rules; what is left is a short
list that decides terms of one word. A term of several words is searched with
its pattern only where all of its words are there, and a term that cannot be
written out is searched everywhere.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.strings import SPACE, all_of, any_of

ABSTAIN, NOT_SME, SME = -1, 0, 1

WORD_CHAR = r"\p{L}\p{N}_"
WORDS_COLUMN = "_rule_words"
TEXT_COLUMN = "_rule_text"


@dataclass(frozen=True)
class Rule:
    """Votes ``vote`` when every group has a term present and no excluded term is."""

    name: str
    vote: int
    groups: tuple[tuple[str, ...], ...]
    none_of: tuple[str, ...] = ()
    active: bool = True

    @property
    def votes(self) -> tuple[int, ...]:
        return (self.vote,)


@dataclass(frozen=True)
class ColumnRule:
    """A rule written as a function from the lower-cased text column to a vote column."""

    name: str
    compute: Callable[[Column], Column]
    votes: tuple[int, ...] = (NOT_SME, SME)
    active: bool = True


AnyRule = Rule | ColumnRule


def bounded_pattern(terms: Sequence[str]) -> str:
    """Any of the terms as whole words, with Unicode-aware boundaries."""
    return rf"(^|[^{WORD_CHAR}])({_pattern(terms)})($|[^{WORD_CHAR}])"


def _pattern(terms: Sequence[str]) -> str:
    return "|".join(t.replace(r"\s", rf"[{SPACE}]") for t in terms)


# Pieces of a term that can be written out: a part of a group, white space, a letter or a sign that stands for itself.
PIECE = re.compile(r"(?P<open>\()|(?P<close>\))|(?P<bar>\|)|(?P<space>\\s\+?)|(?P<char>[\w '\-])")
MOST_SPELLINGS = 64


def spellings(term: str) -> list[str] | None:
    """All a term matches, white space of any kind as one line feed; null if it says more than groups, bars and ``?`` do."""
    stack: list[tuple[list[str], list[str]]] = [([], [""])]  # per open group: finished branches, the one being read
    at = 0
    while at < len(term):
        piece = PIECE.match(term, at)
        if piece is None:
            return None
        at = piece.end()
        if piece["open"]:
            stack.append(([], [""]))
            continue
        done, branch = stack.pop()
        if piece["bar"]:
            stack.append(([*done, *branch], [""]))
            continue
        if piece["close"]:
            if not stack:
                return None
            last = [*done, *branch]
            done, branch = stack.pop()
        else:
            last = ["\n" if piece["space"] else piece["char"]]
        if term.startswith("?", at):
            at, last = at + 1, [*last, ""]
        branch = [b + x for b in branch for x in last]
        if len(branch) > MOST_SPELLINGS:
            return None
        stack.append((done, branch))
    if len(stack) != 1:
        return None
    return sorted({*stack[0][0], *stack[0][1]})


def _needed_words(term: str) -> list[tuple[str, ...]] | None:
    """Per spelling the words that a text with it has; null if any spelling has none, or the term cannot be written out."""
    written = spellings(term)
    needed = [tuple(re.findall(r"\w+", x)) for x in written or [""]]
    return needed if all(needed) else None


def _is_plain(term: str) -> bool:
    """Whether a text has the term exactly if it has one of its spellings as a word."""
    return all(re.fullmatch(r"\w+", x) for x in spellings(term) or [""])


def _sought_words(rules: Sequence[AnyRule]) -> list[str]:
    """Every word that a term of the rules needs."""
    terms = {t for r in rules if isinstance(r, Rule) for group in (*r.groups, r.none_of) for t in group}
    return sorted({w for t in terms for words in _needed_words(t) or [] for w in words})


def _has_term(terms: Sequence[str], words: Column, text: Column) -> Column:
    plain = sorted({x for t in terms if _is_plain(t) for x in spellings(t)})
    longer = [t for t in terms if not _is_plain(t) and _needed_words(t)]
    others = [t for t in terms if not _needed_words(t)]
    tests = []
    if plain:
        tests.append(F.arrays_overlap(words, F.array(*[F.lit(t) for t in plain])))
    if longer:
        needed = sorted({n for t in longer for n in _needed_words(t)})
        present = any_of([all_of([F.array_contains(words, w) for w in n]) for n in needed])
        tests.append(present & text.rlike(bounded_pattern(longer)))
    if others:
        found = text.rlike(bounded_pattern(others))
        # without bounds a pattern is ruled out faster, but its groups have other numbers
        tests.append(found if re.search(r"\\\d", _pattern(others)) else text.rlike(_pattern(others)) & found)
    return any_of(tests)


def rule_vote(rule: AnyRule, words: Column, text: Column) -> Column:
    if isinstance(rule, ColumnRule):
        return F.coalesce(rule.compute(text), F.lit(ABSTAIN)).cast("int")
    hit = all_of([_has_term(group, words, text) for group in rule.groups])
    if rule.none_of:
        hit = hit & ~_has_term(rule.none_of, words, text)
    return F.when(hit, F.lit(rule.vote)).otherwise(F.lit(ABSTAIN))


def active_rules(rules: Sequence[AnyRule]) -> list[AnyRule]:
    return [r for r in rules if r.active]


def apply_rules(df: DataFrame, rules: Sequence[AnyRule], text: str = "clean_geo") -> DataFrame:
    """One integer vote column per active rule.

    The votes of a row are made together and exploded as one: a filter on a vote
    or on a score would else be pushed below the words and make them once per vote.
    """
    lowered = df.withColumn(TEXT_COLUMN, F.lower(F.coalesce(F.col(text), F.lit(""))))
    active = active_rules(rules)
    sought = F.array(*[F.lit(w) for w in _sought_words(active)]).cast("array<string>")
    words = F.split(F.col(TEXT_COLUMN), rf"[^{WORD_CHAR}]+", -1)
    worded = lowered.withColumn(WORDS_COLUMN, F.array_intersect(words, sought))
    votes = [rule_vote(r, F.col(WORDS_COLUMN), F.col(TEXT_COLUMN)).alias(r.name) for r in active]
    if not votes:
        return df
    return worded.select(*[F.col(c) for c in df.columns], F.inline_outer(F.array(F.struct(*votes))))


def indicators(rules: Sequence[AnyRule]) -> list[tuple[str, int]]:
    """The (rule, vote) pairs that can occur; abstaining is not one of them."""
    return [(r.name, v) for r in active_rules(rules) for v in r.votes]


def _slot(a: tuple[str, int], b: tuple[str, int]) -> str:
    return f"{a[0]}={a[1]}&{b[0]}={b[1]}"


def vote_sums(votes: DataFrame, rules: Sequence[AnyRule]) -> DataFrame:
    """One row: number of articles, and for each pair of indicators how many have both.

    A single aggregate whose size depends on the number of rules only.
    """
    cols = indicators(rules)
    exprs = [F.count(F.lit(1)).alias("n")]
    for i, a in enumerate(cols):
        for b in cols[i:]:
            exprs.append(F.count_if((F.col(a[0]) == a[1]) & (F.col(b[0]) == b[1])).alias(_slot(a, b)))
    return votes.agg(*exprs)


def vote_moments(votes: DataFrame, rules: Sequence[AnyRule]) -> DataFrame:
    """(rule_a, vote_a, rule_b, vote_b, share): how often two votes occur together."""
    cols = indicators(rules)
    sums = vote_sums(votes, rules)
    rows = [
        F.struct(
            F.lit(a[0]).alias("rule_a"), F.lit(a[1]).alias("vote_a"),
            F.lit(b[0]).alias("rule_b"), F.lit(b[1]).alias("vote_b"),
            F.try_divide(F.col(f"`{_slot(a, b)}`").cast("double"), F.col("n")).alias("share"),
        )
        for i, a in enumerate(cols)
        for b in cols[i:]
    ]
    return sums.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def rule_coverage(votes: DataFrame, rules: Sequence[AnyRule]) -> DataFrame:
    """(rule, coverage, sme, not_sme) as shares of all articles."""
    names = [r.name for r in active_rules(rules)]
    sums = votes.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(r) == v).alias(f"{r}={v}") for r in names for v in (SME, NOT_SME)],
    )

    def share(count: Column) -> Column:
        return F.try_divide(count.cast("double"), F.col("n"))

    rows = [
        F.struct(
            F.lit(r).alias("rule"),
            share(F.col(f"`{r}={SME}`") + F.col(f"`{r}={NOT_SME}`")).alias("coverage"),
            share(F.col(f"`{r}={SME}`")).alias("sme"),
            share(F.col(f"`{r}={NOT_SME}`")).alias("not_sme"),
        )
        for r in names
    ]
    return sums.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def majority_vote(rules: Sequence[AnyRule]) -> Column:
    """Label of the majority of votes; a tie or no vote abstains."""
    names = [r.name for r in active_rules(rules)]
    balance = sum(
        (F.when(F.col(r) == SME, 1).when(F.col(r) == NOT_SME, -1).otherwise(0) for r in names[1:]),
        F.when(F.col(names[0]) == SME, 1).when(F.col(names[0]) == NOT_SME, -1).otherwise(0),
    )
    return F.when(balance > 0, F.lit(SME)).when(balance < 0, F.lit(NOT_SME)).otherwise(F.lit(ABSTAIN))
