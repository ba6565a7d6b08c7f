"""Upserts from streams: latest value for each key, from files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .buckets import BucketTable


def latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; the state a stream of upserts ends in."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("x")).select(*key, "x.*")


def latest_table(spark: SparkSession, folder: str, key: list[str], order: list[str], buckets: int = 64) -> BucketTable:
    """A bucket table that keeps the last row of each key, whatever batch it came in."""
    return BucketTable(spark, folder, key, lambda rows: latest(rows, key, order).select(rows.columns), buckets)


def streamed_latest(spark: SparkSession, folder: str, schema: str, key: list[str], order: list[str], pattern: str = "*") -> DataFrame:
    """``latest`` over a folder of parquet files as a streaming aggregation (complete or update mode)."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", 1).parquet(folder)
    return latest(stream, key, order)


def upsert_stream(source: DataFrame, table: BucketTable, checkpoint: str) -> StreamingQuery:
    """Merges each micro-batch into a bucket table, under the batch's number.

    A batch rewrites the buckets its keys fall into; one that comes again after a failure
    finds its version and adds nothing.
    """
    def write(batch: DataFrame, number: int) -> None:
        table.merge(batch, number)

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts in tumbling windows; rows later than the watermark are dropped by a stream, none by a batch."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n")).select("w.start", "w.end", key, "n")
