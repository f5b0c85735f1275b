"""Statistics over the Rating table (popularity, recent popularity, average).

All three are single hash aggregations with map-side partial aggregation, so
a product holding a third of all ratings is pre-combined in every map task
before the shuffle.  No global sort is written: ordering belongs to readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.expr import rating_month
from recspark.session import checkpoint_dir


def rate_more_products(ratings: DataFrame) -> DataFrame:
    """productId, count (NULL product ids are not counted)."""
    return (ratings.where(F.col("productId").isNotNull())
            .groupBy("productId").agg(F.count("productId").alias("count")))


def ratings_by_month(ratings: DataFrame) -> DataFrame:
    """(productId, score, yearmonth) projection."""
    return ratings.select("productId", "score", rating_month("ts").alias("yearmonth"))


def rate_more_recently_products(ratings: DataFrame) -> DataFrame:
    """productId, count, yearmonth: count per (month, product)."""
    return (ratings_by_month(ratings).where(F.col("productId").isNotNull())
            .groupBy("yearmonth", "productId")
            .agg(F.count("productId").alias("count"))
            .select("productId", "count", "yearmonth"))


def average_products(ratings: DataFrame) -> DataFrame:
    """productId, avg(score); ratings without a product have no row."""
    return ratings.where(F.col("productId").isNotNull()).groupBy("productId").agg(F.avg("score").alias("avg"))


def statistics_tables(ratings: DataFrame):
    """All three statistics from one scan of the ratings.

    One partial aggregation by (yearmonth, productId) keeps count and score
    sum; it is as large as products x months, far below the ratings, and the
    three tables are cheap re-aggregations of it, each agreeing with its own
    operator above.  Returns ``(rate_more, rate_more_recently, average)``.
    """
    monthly = (ratings.where(F.col("productId").isNotNull())
               .select("productId", "score", rating_month("ts").alias("yearmonth"))
               .groupBy("yearmonth", "productId")
               .agg(F.count(F.lit(1)).alias("count"), F.sum("score").alias("score_sum"),
                    F.count("score").alias("n_scores")))
    checkpoint_dir(ratings.sparkSession)
    monthly = monthly.checkpoint()
    recent = monthly.select("productId", "count", "yearmonth")
    per_product = monthly.groupBy("productId").agg(
        F.sum("count").alias("count"), F.sum("score_sum").alias("score_sum"),
        F.sum("n_scores").alias("n_scores"))
    rate_more = per_product.select("productId", "count")
    average = per_product.select(
        "productId", F.try_divide(F.col("score_sum"), F.col("n_scores")).alias("avg"))
    return rate_more, recent, average


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("userId").distinct()


def distinct_products(ratings: DataFrame) -> DataFrame:
    return ratings.select("productId").distinct()


def user_item_space(ratings: DataFrame) -> DataFrame:
    """Size of the user x product space the original scored pair by pair.

    Two distinct counts in one pass; the pairs themselves are never built
    (per-user top lists come from blocked ALS recommendation instead).
    """
    return ratings.agg(F.count_distinct("userId").alias("n_users"),
                       F.count_distinct("productId").alias("n_products")) \
                  .withColumn("n_pairs", F.col("n_users") * F.col("n_products"))


def rmse(predictions: DataFrame, real: str = "real", pred: str = "pred") -> DataFrame:
    """sqrt(mean((real - pred)^2)) over rows that have a prediction."""
    d = F.col(real) - F.col(pred)
    return (predictions.where(F.col(pred).isNotNull())
            .agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.count(F.lit(1)).alias("n")))
