"""Filters of the exploration view and saved filter specifications."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from newsloom.functions.strings import all_of, any_of
from newsloom.operators.rows import explode_rows


def text_matches(schema: StructType, query: str, literal: bool = True) -> Column:
    """Case-insensitive search in every text column and in every element of a list of texts.

    A literal query is matched as written; otherwise it is a pattern. Missing
    values never match.
    """
    if not query:
        return F.lit(True)
    pattern = "(?iu)" + (re.escape(query) if literal else query)
    tests = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            tests.append(column.rlike(pattern))
        elif isinstance(field.dataType, ArrayType) and isinstance(field.dataType.elementType, StringType):
            tests.append(F.exists(column, lambda x: x.rlike(pattern)))
        elif isinstance(field.dataType, (ArrayType, StructType, MapType)):
            tests.append(F.to_json(column).rlike(pattern))
    return F.coalesce(any_of([F.coalesce(t, F.lit(False)) for t in tests]), F.lit(False))


def feed_in(feeds: Sequence[str] | None, feed: str = "feed") -> Column:
    """Selected feeds; None selects all, an empty list none. Rows without a feed go.

    A bare comparison, null for a missing feed, so that a scan can use it.
    """
    if feeds is None:
        return F.lit(True)
    return F.col(feed).isin(list(feeds)) if feeds else F.lit(False)


def location_tags(search: str, locations: str = "locations") -> Column:
    """Any comma-separated tag is part of any location, ignoring case."""
    tags = [t.strip().lower() for t in (search or "").split(",") if t.strip()]
    if not tags:
        return F.lit(True)
    hit = F.exists(locations, lambda l: any_of([F.contains(F.lower(l), F.lit(t)) for t in tags]))
    return F.coalesce(hit, F.lit(False))


def date_between(ts: Column | str, start: date | str | Column, end: date | str | Column) -> Column:
    """Calendar date inside the inclusive range; undated rows go.

    Compares the bare time stamp with the first moment of the range and of the
    day after it, null for a missing one, so that a scan can use it.
    """

    def bound(v):
        return v if isinstance(v, Column) else F.lit(v).cast("date")

    column = F.col(ts) if isinstance(ts, str) else ts
    return (column >= bound(start).cast("timestamp")) & (column < F.date_add(bound(end), 1).cast("timestamp"))


def since(ts: Column | str, cutoff: date | str) -> Column:
    """Dated at or after the cutoff; comparing the bare column lets the scan use it."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return column >= F.lit(cutoff).cast("timestamp")


def date_bounds(df: DataFrame, ts: str = "published_ts") -> DataFrame:
    """One row: earliest and latest calendar date."""
    return df.agg(F.to_date(F.min(ts)).alias("min_d"), F.to_date(F.max(ts)).alias("max_d"))


def _clamped(min_d: Column, max_d: Column, start: str | date | None, end: str | date | None) -> tuple[Column, Column]:
    def parsed(v) -> Column:
        return F.lit(None).cast("date") if v is None else F.lit(str(v)).try_cast("date")

    def inside(v: Column) -> Column:
        return F.greatest(F.least(v, max_d), min_d)

    s, e = parsed(start), parsed(end)
    full = s.isNull() | e.isNull() | (inside(s) > inside(e))
    return F.when(full, min_d).otherwise(inside(s)), F.when(full, max_d).otherwise(inside(e))


def clamp_range(bounds: DataFrame, start: str | date | None, end: str | date | None) -> DataFrame:
    """Range moved inside the bounds; unreadable or inverted means the full range."""
    s, e = _clamped(F.col("min_d"), F.col("max_d"), start, end)
    return bounds.select(s.alias("start_d"), e.alias("end_d"))


@dataclass(frozen=True)
class FilterSpec:
    """What a user asked to see; every default means no restriction.

    Where a frame has publication times, undated rows are never shown, unless
    ``undated`` asks for them and no range is given.
    """

    text_filter: str = ""
    selected_feeds: tuple[str, ...] | None = None
    location_search: str = ""
    date_range: tuple[str, str] | None = None
    literal: bool = True
    undated: bool = False

    @classmethod
    def from_mapping(cls, saved: Mapping) -> FilterSpec:
        feeds = saved.get("selected_feeds")
        span = saved.get("date_range")
        return cls(
            text_filter=saved.get("text_filter") or "",
            selected_feeds=None if feeds is None else tuple(feeds),
            location_search=saved.get("location_search") or "",
            date_range=tuple(map(str, span)) if isinstance(span, (list, tuple)) and len(span) == 2 else None,
        )


def spec_condition(
    df: DataFrame, spec: FilterSpec, feed: str = "feed", locations: str = "locations", ts: str = "published_ts",
    bounds: Column | None = None,
) -> Column:
    """One predicate for a whole specification, null or false where it fails. Cheap tests come first.

    A date range is first clamped to the dates of ``df``: ``bounds`` holds them,
    or they become a scalar subquery of the predicate.
    """
    parts = []
    names = set(df.columns)
    if feed in names:
        parts.append(feed_in(spec.selected_feeds, feed))
    if ts in names:
        if spec.date_range is not None:
            span = _bounds(df, ts) if bounds is None else bounds
            parts.append(date_between(ts, *_clamped(span["min_d"], span["max_d"], *spec.date_range)))
        elif not spec.undated:
            parts.append(F.col(ts).isNotNull())
    if locations in names:
        parts.append(location_tags(spec.location_search, locations))
    parts.append(text_matches(df.schema, spec.text_filter, spec.literal))
    return all_of(parts)


def _bounds(df: DataFrame, ts: str) -> Column:
    return date_bounds(df, ts).select(F.struct("min_d", "max_d")).scalar()


def apply_filters(df: DataFrame, spec: FilterSpec, ts: str = "published_ts") -> DataFrame:
    """Rows a specification keeps."""
    return df.where(spec_condition(df, spec, ts=ts))


def tag_presets(df: DataFrame, presets: Mapping[str, FilterSpec], ts: str = "published_ts") -> DataFrame:
    """(preset, row…): each row once per preset that keeps it, in one pass.

    Presets are a handful of saved specifications, so each is compiled to a
    predicate on the row; rows are not joined with them. A preset keeps the
    rows that ``apply_filters`` keeps.
    """
    ranged = ts in df.columns and any(spec.date_range is not None for spec in presets.values())
    bounded = df.withColumn("_bounds", _bounds(df, ts)) if ranged else df
    hits = [F.when(spec_condition(df, spec, ts=ts, bounds=F.col("_bounds")), F.lit(name)) for name, spec in presets.items()]
    return explode_rows(bounded, F.array_compact(F.array(*hits)), "preset", list(df.columns))


def keep_ratio(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """(stage, kept, total, ratio) of several conditions in one aggregate."""
    sums = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.coalesce(cond, F.lit(False))).alias(f"kept_{i}") for i, cond in enumerate(stages.values())],
    )
    rows = [
        F.struct(
            F.lit(name).alias("stage"),
            F.col(f"kept_{i}").alias("kept"),
            F.col("total"),
            F.try_divide(F.col(f"kept_{i}").cast("double"), F.col("total")).alias("ratio"),
        )
        for i, name in enumerate(stages)
    ]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def feed_options(df: DataFrame, feed: str = "feed") -> DataFrame:
    return df.select(feed).where(F.col(feed).isNotNull()).distinct()
