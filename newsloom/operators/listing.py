"""Listing pages to one row per item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import try_layouts
from newsloom.functions.markup import drop_hidden, html_to_text, resolve_url
from newsloom.functions.strings import collapse_ws
from newsloom.operators.rows import explode_rows


def listing_rows(
    pages: DataFrame,
    item: str,
    fields: dict[str, str],
    date_layouts: Sequence[str] = (),
    html: str = "html",
    base: str = "url",
) -> DataFrame:
    """Explode each page into its items and read the fields of every item.

    ``item`` and the ``fields`` are patterns whose first group is the value.
    A field named ``href`` is resolved against the page; the others become
    plain text. With ``date_layouts`` items without a readable ``date`` field
    are skipped, and ``date_ts`` holds the parsed value. A field an item lacks
    is empty, never taken over from the item before.
    """
    matches = F.regexp_extract_all(drop_hidden(html), F.lit(item), 1)
    items = explode_rows(pages, matches, "_item", list(pages.columns), pos="item_no")
    values = {}
    for name, pattern in fields.items():
        raw = F.regexp_extract("_item", pattern, 1)
        values[name] = resolve_url(base, raw) if name == "href" else collapse_ws(html_to_text(raw))
    rows = items.select(*[c for c in pages.columns if c != html], "item_no", *[v.alias(n) for n, v in values.items()])
    if date_layouts:
        rows = rows.withColumn("date_ts", try_layouts("date", *date_layouts)).where("date_ts is not null")
    return rows
