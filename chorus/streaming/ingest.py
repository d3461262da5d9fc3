"""Incremental ingest: the same functions as the batch path on a file stream."""

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from chorus.operators.hygiene import accepted
from chorus.schema import DOC, ENTITY, RESULT_KEY
from chorus.sources.feed import feed_reviews
from chorus.sources.results import write_results

MAX_FILES_PER_TRIGGER = 10_000
LANDED = "landed_at"


def landed_pages(spark: SparkSession, path: str, schema: StructType | str, only: str = "*") -> DataFrame:
    """Page files as a stream with ``landed_at``; each file is read once, in bounded batches."""
    files = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", only)
        .option("maxFilesPerTrigger", MAX_FILES_PER_TRIGGER)
        .parquet(path)
    )
    return files.select("*", F.col("_metadata.file_modification_time").alias(LANDED))


def stream_reviews(pages: DataFrame, raw: str = "raw", after: date | datetime | None = None) -> DataFrame:
    """Streamed pages to accepted unified reviews: flatten, parse, conform, cut off."""
    return accepted(feed_reviews(pages, raw, after))


def stream_dedup(
    reviews: DataFrame, delay: str = "7 days", entity: list[str] = ENTITY, doc: str = DOC, ts: str = LANDED
) -> DataFrame:
    """Each review once; a copy that lands more than ``delay`` after the first may come out again.

    Time is when a file landed, not the review's own date: an old review that
    lands late, never seen before, is new.
    """
    return reviews.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*entity, doc])


def append_to(reviews: DataFrame, path: str, checkpoint: str, by: list[str] | None = None) -> StreamingQuery:
    """Process everything landed so far into a table, then stop."""
    writer = (
        reviews.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    return (writer.partitionBy(*by) if by else writer).start()


def stream_upsert(
    updates: DataFrame, root: str, checkpoint: str, key: list[str] = RESULT_KEY
) -> StreamingQuery:
    """Upsert each micro-batch of results; a replayed batch leaves the same rows."""

    def merge(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            write_results(batch.sparkSession, root, batch, key)

    return (
        updates.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


__all__ = [
    "append_to", "landed_pages", "stream_dedup", "stream_reviews", "stream_upsert",
]
