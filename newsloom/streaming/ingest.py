"""Continuous ingest of landed article files."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsloom.functions.cleaning import with_clean_geo
from newsloom.functions.strings import nonblank, raw_text
from newsloom.operators.dedupe import new_only
from newsloom.operators.label_model import LabelModel, label
from newsloom.operators.rules import AnyRule, active_rules, apply_rules
from newsloom.schemas import ARTICLE

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REMEMBER = "7 days"
# The state store that keeps keys on disk, for ``spark.sql.streaming.stateStore.providerClass``.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def article_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ARTICLE).option("pathGlobFilter", "*.json")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def dedupe_stream(articles: DataFrame, remember: str = REMEMBER) -> DataFrame:
    """One row for each address, from the first micro-batch that brings it.

    Which of several rows of one address inside a micro-batch stays is not
    determined; ``exact_append`` goes by an order.

    The watermark runs on the time of arrival, which never goes back, so no
    article is ever too late and none is lost. An address is remembered for
    ``remember`` after it arrived, which bounds the state; one that returns
    later than that is let in again. ``exact_append`` has no such limit.
    """
    arrived = articles.where(nonblank("url")).withColumn("arrived_at", F.current_timestamp())
    return arrived.withWatermark("arrived_at", remember).dropDuplicatesWithinWatermark(["url"])


def _first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose key, the last column, has not come before in this task."""
    seen: set[bytes] = set()
    for rows in batches:
        keep = []
        for key in rows.column(rows.num_columns - 1).to_pylist():
            keep.append(key not in seen)
            seen.add(key)
        yield rows.filter(pa.array(keep, pa.bool_()))


def keyed_stream(articles: DataFrame) -> DataFrame:
    """One row for each address, ever, from the first micro-batch that brings it.

    The state is keyed by a 128-bit digest of the address and holds nothing
    else, in the store of the session (``ROCKSDB`` keeps it on disk); no text
    is remembered and no stored table is read, so the input of a micro-batch is
    what arrived, however long the stream has run. Repeats inside a task are
    folded before the shuffle: an address that fills a third of a batch sends
    one row per task. Which of several rows of one address stays is not
    determined inside a micro-batch; ``exact_append`` goes by an order.
    """
    columns = articles.columns
    keyed = articles.where(nonblank("url")).withColumn("_address", F.unhex(F.md5("url")))
    return keyed.mapInArrow(_first_of_task, keyed.schema).dropDuplicates(["_address"]).select(*columns)


def score_stream(articles: DataFrame, rules: Sequence[AnyRule], model: LabelModel, min_conf: float = 0.6) -> DataFrame:
    """Clean, vote and score with a model fitted beforehand; all row by row."""
    cleaned = with_clean_geo(articles, raw_text())
    names = [r.name for r in active_rules(rules)]
    return label(apply_rules(cleaned, rules), model, min_conf).drop(*names)


def append_to_table(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append to a Parquet table; the sink's log makes each batch count once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def exact_append(
    stream: DataFrame, path: str, checkpoint: str, order: list[str], available_now: bool = True
) -> StreamingQuery:
    """Append articles whose address the table has never held.

    Every micro-batch runs the batch operator, which reduces repeats inside
    the batch before the shuffle and then drops stored addresses. A batch that
    is replayed after a failure finds its own rows stored and adds nothing.
    """
    schema = stream.schema

    def stored(spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def add(batch: DataFrame, _: int) -> None:
        new_only(batch, stored(batch.sparkSession), order).write.mode("append").parquet(path)

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
