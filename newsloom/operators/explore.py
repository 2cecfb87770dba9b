"""Place aggregates and the spotlight list of the exploration view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.lookup import collect_bounded, lookup_join, member_of
from newsloom.operators.rows import explode_rows

SPOTLIGHT_SIZE = 5
UNTITLED = "Untitled Article"


def located_mentions(
    df: DataFrame, coordinates: DataFrame, locations: str = "locations", id_col: str = "doc_id", title: str = "title"
) -> DataFrame:
    """(location, lat, lon, title) per mention that has coordinates; names match case-sensitively."""
    named = F.coalesce(F.col(title), F.lit(UNTITLED)).alias("title")
    each = explode_rows(df, locations, "location", [id_col, named], pos="pos")
    joined = lookup_join(each, coordinates, "location", spread_by=[id_col, "pos"])
    return joined.select("location", "lat", "lon", "title")


def location_weights(mentions: DataFrame) -> DataFrame:
    """(location, lat, lon, weight): number of mentions, combined before the shuffle."""
    return mentions.groupBy("location", "lat", "lon").agg(F.count(F.lit(1)).alias("weight"))


def location_titles(mentions: DataFrame) -> DataFrame:
    """(location, lat, lon, title, mentions): the titles of each place.

    One row per title with its number of mentions, not one list per place: a
    place named by a third of all articles must not become one giant value.
    """
    return mentions.groupBy("location", "lat", "lon", "title").agg(F.count(F.lit(1)).alias("mentions"))


def in_region(names: list[str], locations: str = "locations") -> Column:
    """Any location is a region name, ignoring case; no locations is false."""
    return F.coalesce(F.exists(locations, lambda l: member_of(F.lower(l), names)), F.lit(False))


def flag_region(
    df: DataFrame, region: DataFrame, locations: str = "locations", id_col: str = "doc_id", max_values: int | None = None
) -> DataFrame:
    """Adds ``in_region``. A small region is a hash set in the row; a large one is joined."""
    names = collect_bounded(region, "name_lower", *([] if max_values is None else [max_values]))
    if names is not None:
        return df.withColumn("in_region", in_region(names, locations))
    lowered = F.array_distinct(F.transform(locations, lambda l: F.lower(l)))
    each = explode_rows(df, lowered, "name_lower", [id_col])
    hits = lookup_join(each, region, "name_lower", "left_semi", spread_by=[id_col]).select(id_col).distinct()
    flagged = df.join(hits.withColumn("in_region", F.lit(True)), id_col, "left")
    return flagged.withColumn("in_region", F.coalesce("in_region", F.lit(False)))


def region_semi(df: DataFrame, region: DataFrame, locations: str = "locations", id_col: str = "doc_id") -> DataFrame:
    return flag_region(df, region, locations, id_col).where("in_region").drop("in_region")


def top_probability(df: DataFrame, k: int = SPOTLIGHT_SIZE, id_col: str = "doc_id") -> DataFrame:
    """The k most probable articles, unscored ones last."""
    return df.orderBy(F.desc_nulls_last("sme_probability"), F.asc(id_col)).limit(k)


def spotlight(
    df: DataFrame, region: DataFrame, k: int = SPOTLIGHT_SIZE, locations: str = "locations", id_col: str = "doc_id"
) -> DataFrame:
    """Articles in the region and the k most probable ones, once each, with the reason."""
    best = top_probability(df, k, id_col).select(id_col, F.lit(True).alias("_top"))
    flagged = flag_region(df, region, locations, id_col).join(F.broadcast(best), id_col, "left")
    reason = F.concat_ws("+", F.when(F.col("in_region"), "region"), F.when(F.col("_top"), "probability"))
    return flagged.where("in_region or _top").withColumn("reason", reason).drop("in_region", "_top")
