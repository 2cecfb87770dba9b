"""Appending sources and keeping one row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.strings import is_blank, nonblank


# Largest rank for which Spark limits groups before the shuffle, by default.
GROUP_LIMIT = 1000
SLICES = 64


def union_sources(*frames: DataFrame) -> DataFrame:
    """Append sources by column name; columns a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_sources(*frames).distinct()


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key in the given order.

    Spark turns the rank filter into a group limit before the shuffle, so each
    map task sends at most one row per key however often the key repeats.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def url_dedupe(df: DataFrame, order: list[str | Column], url: str = "url") -> DataFrame:
    """First article per address; articles without an address are dropped."""
    return keep_first(df.where(nonblank(url)), [url], order)


def feed_dedupe(
    df: DataFrame,
    order: list[str],
    feed: str = "feed",
    link: str = "url",
    blank: str = "keep",
) -> DataFrame:
    """First entry per link inside each feed.

    Entries without a link are all kept or all dropped. When kept, each is its
    own group, so they spread over tasks instead of meeting under one key.
    """
    if blank == "drop":
        return keep_first(df.where(nonblank(link)), [feed, link], order)
    if blank != "keep":
        raise ValueError("blank must be 'keep' or 'drop'")
    own = F.when(is_blank(link), F.struct(*[F.col(c) for c in order]))
    return keep_first(df.withColumn("_own", own), [feed, link, "_own"], order).drop("_own")


def head_per_feed(
    df: DataFrame, n: int | None, order: list[str | Column], feed: str = "feed", slices: int = SLICES
) -> DataFrame:
    """First ``n`` rows of each feed; None or 0 keeps all.

    Up to a size Spark limits the groups on the map side. Beyond it each feed
    is first limited in slices, so a feed with a third of all rows reaches its
    last task with at most ``n`` rows per slice. ``slices`` should grow with
    the rows of the largest feed; the columns of the order choose the slice.
    """
    if not n:
        return df

    def first(rows: DataFrame, *keys: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")

    if n > GROUP_LIMIT:
        spread = [F.col(c) for c in order if isinstance(c, str)] or [F.col(f"`{c}`") for c in df.columns]
        sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*spread), F.lit(slices)))
        df = first(sliced, feed, "_slice").drop("_slice")
    return first(df, feed)


def head_feeds(df: DataFrame, m: int | None, feed: str = "feed", feed_order: str | None = None) -> DataFrame:
    """Rows of the first ``m`` feeds; None or 0 keeps all."""
    if not m:
        return df
    by = feed_order or feed
    ranked = df.where(F.col(feed).isNotNull()).groupBy(feed).agg(F.min(by).alias("_by"))
    first = ranked.orderBy("_by", feed).limit(m).select(feed)
    return df.join(F.broadcast(first), feed, "left_semi")


def new_only(incoming: DataFrame, existing: DataFrame, order: list[str | Column], url: str = "url") -> DataFrame:
    """Incoming articles whose address is not stored yet, once each.

    Both sides are reduced to one row per address before they meet, so an
    address repeated many times costs one row per task, not one huge task.
    """
    known = existing.where(nonblank(url)).select(url).distinct()
    return url_dedupe(incoming, order, url).join(known, url, "left_anti")
