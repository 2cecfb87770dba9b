"""Publication dates: composing, parsing and ingest time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.strings import _col, strip

# The date layouts the sources emit, weekday removed.
FEED_LAYOUTS = ("d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss")
ARCHIVE_LAYOUTS = ("dd-MM-yyyy HH:mm", "dd-MM-yyyy", "MMMM d, yyyy")
PUBLISHED_LAYOUT = "EEE, dd MMM yyyy HH:mm:ss"


def try_layouts(c: Column | str, *layouts: str) -> Column:
    """First layout that parses wins; none parsing gives null, never an error."""
    return F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(layout)) for layout in layouts])


def published_ts(c: Column | str) -> Column:
    text = strip(c)
    undated = F.regexp_replace(text, r"^[A-Za-z]{3,9},\s*", "")
    return F.coalesce(
        try_layouts(undated, *FEED_LAYOUTS),
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text)),
        try_layouts(text, *ARCHIVE_LAYOUTS),
    )


def archive_ts(date: Column | str, time: Column | str) -> Column:
    """Day in the layout of archives or of listings, and a time of 24 or 12 hours; a missing time means midnight."""
    joined = F.concat_ws(" ", strip(date), F.nullif(strip(time), F.lit("")))
    return F.coalesce(
        *[F.try_to_timestamp(joined, F.lit(f"{day} {hour}")) for hour in ("HH:mm", "hh:mm a") for day in ("dd-MM-yyyy", "yyyy-MM-dd")],
        F.try_to_timestamp(strip(date), F.lit("dd-MM-yyyy")),
        F.try_to_timestamp(strip(date), F.lit("yyyy-MM-dd")),
    )


def compose_published(date: Column | str, time: Column | str) -> Column:
    return F.date_format(archive_ts(date, time), PUBLISHED_LAYOUT)


def ingest_ts() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
