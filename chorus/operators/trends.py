"""Topics read together with the reviews' time, app version and rating.

Inputs carry the review's own columns next to its topic shares, so a trend is
one partially aggregated grouping without a join back to the reviews.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorus.schema import ENTITY


def _mean_share(doc_topic: DataFrame, by: list[str], axis: Column, name: str) -> DataFrame:
    """Mean theta per topic; documents without a row for a topic count as zero share.

    ``n_docs`` counts documents of the topic with a positive share.
    """
    per_topic = doc_topic.withColumn(name, axis).groupBy(*by, name, "topic").agg(
        F.sum("theta").alias("_theta"), F.count_if(F.col("theta") > 0).alias("n_docs")
    )
    whole = F.sum("_theta").over(Window.partitionBy(*by, name))
    return per_topic.select(*by, name, "topic", (F.col("_theta") / whole).alias("mean_theta"), "n_docs")


def topic_by_period(
    doc_topic: DataFrame, by: list[str] = ENTITY, ts: str = "ts", unit: str = "month"
) -> DataFrame:
    """Share of each topic per calendar period. Shares of a document sum to 1."""
    return _mean_share(doc_topic, by, F.date_trunc(unit, ts), "period")


def topic_by_version(doc_topic: DataFrame, by: list[str] = ENTITY, version: str = "app_version") -> DataFrame:
    return _mean_share(doc_topic, by, F.col(version), "version")


def topic_by_rating(doc_topic: DataFrame, by: list[str] = ENTITY, rating: str = "rating") -> DataFrame:
    """Average rating of each topic, every review weighted by its share of the topic."""
    rated = doc_topic.filter(F.col(rating).isNotNull())
    return rated.groupBy(*by, "topic").agg(
        (F.sum(F.col("theta") * F.col(rating)) / F.sum("theta")).alias("mean_rating"),
        F.count_if(F.col("theta") > 0).alias("n_docs"),
    )
