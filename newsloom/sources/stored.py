"""The stored articles as a table in buckets by address.

Rows of one address lie in one bucket, so that a join or a de-duplication by
address reads the buckets where they are: only what arrives is shuffled, into as
many parts as there are buckets, whatever the size of the table. Give a table at least
as many buckets as the session has shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.strings import nonblank
from newsloom.operators.dedupe import url_dedupe

BUCKETS = 64


def store_articles(
    articles: DataFrame, table: str, buckets: int = BUCKETS, url: str = "url", mode: str = "overwrite", path: str | None = None
) -> None:
    """Write articles in buckets by address, one file per bucket and write; articles without an address are left out.

    Columns are those of the table. A later write with ``mode="append"`` must name the same number of buckets.
    ``path`` is where the files lie, by default the warehouse.
    """
    rows = articles.where(nonblank(url)).repartition(buckets, url)
    rows.write.mode(mode).format("parquet").bucketBy(buckets, url).sortBy(url).saveAsTable(table, path=path)


def stored_articles(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def add_new(
    incoming: DataFrame, table: str, order: list[str], buckets: int = BUCKETS, url: str = "url", path: str | None = None
) -> DataFrame:
    """Append the incoming articles whose address is not stored, once each, and return the table.

    The addresses of the table are read from their buckets without a shuffle
    and without the other columns.
    """
    store_articles(not_stored(incoming, table, order, url), table, buckets, url, "append", path)
    return stored_articles(incoming.sparkSession, table)


def not_stored(incoming: DataFrame, table: str, order: list[str], url: str = "url") -> DataFrame:
    """Incoming articles that the table does not hold, first of each address in the given order."""
    known = stored_articles(incoming.sparkSession, table).select(F.col(url).alias("_stored"))
    fresh = url_dedupe(incoming, order, url)
    return fresh.join(known, fresh[url] == F.col("_stored"), "left_anti")
