"""All registered queries."""

from newsloom.catalog import (  # noqa: F401
    explore_queries,
    ingest_queries,
    place_queries,
    rule_queries,
    text_queries,
)
from newsloom.catalog.registry import QUERIES, STATEMENTS  # noqa: F401
