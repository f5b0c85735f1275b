"""Mapping of the driver's TPC-H-like tables onto the recommender's tables.

Every function reads parquet from ``sf_dir`` and returns a DataFrame whose
work grows with the input.  Each has an SQL twin in ``recspark.plans.sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.constants import RATING_LOG_PREFIX
from recspark.functions.expr import format_rating_event


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch_seconds(c) -> F.Column:
    # parquet timestamps load as TIMESTAMP_NTZ; under UTC this is truncation
    return F.unix_seconds(F.col(c).cast("timestamp"))


def ratings(spark: SparkSession, sf_dir: str, with_order: bool = False) -> DataFrame:
    """lineitem x orders -> Rating(userId, productId, score, ts).

    ``with_order`` adds ``ord``: a struct giving a total order of a user's
    ratings (ship date, order key, line number, part key, quantity).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    df = li.join(od, li.l_orderkey == od.o_orderkey)
    cols = [
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("productId"),
        F.round((1 + F.col("l_quantity").cast("int") % 10) / 2.0, 2).alias("score"),
        _epoch_seconds("l_shipdate").alias("ts"),
    ]
    if with_order:
        cols.append(F.struct(
            F.col("l_shipdate").alias("o1"), F.col("l_orderkey").alias("o2"),
            F.col("l_linenumber").alias("o3"), F.col("l_partkey").alias("o4"),
            F.col("l_quantity").alias("o5")).alias("ord"))
    return df.select(*cols)


def event_ratings(spark: SparkSession, sf_dir: str, with_order: bool = False,
                  with_type: bool = False) -> DataFrame:
    """events -> Rating; ``ord`` = (full-precision ts, event_id)."""
    ev = table(spark, sf_dir, "events")
    cols = [
        F.col("user_id").cast("int").alias("userId"),
        (F.col("event_id") % 500).cast("int").alias("productId"),
        F.round((1 + F.col("event_id") % 10) / 2.0, 2).alias("score"),
        _epoch_seconds("ts").alias("ts"),
    ]
    if with_order:
        cols.append(F.struct(F.col("ts").alias("o1"),
                             F.col("event_id").alias("o2")).alias("ord"))
    if with_type:
        cols += [F.col("event_type"), F.col("event_id")]
    return ev.select(*cols)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings -> (productId, vector ARRAY<DOUBLE>), every row."""
    return (table(spark, sf_dir, "embeddings")
            .select(F.col("vec_id").cast("int").alias("productId"),
                    F.col("embedding").cast("array<double>").alias("vector")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> Product(productId, name, imageUrl, categories, tags)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("productId"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("https://img.example/"), F.col("p_partkey").cast("string"),
                 F.lit(".jpg")).alias("imageUrl"),
        F.concat_ws("|", "p_type", "p_brand").alias("categories"),
        F.concat_ws("|", F.regexp_replace("p_name", " ", "|"), F.col("p_brand"),
                    F.regexp_replace("p_type", " ", "|"),
                    F.concat(F.lit("size"), F.col("p_size").cast("string"))).alias("tags"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> (userId, username)."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("userId"),
        F.col("c_name").alias("username"))


def rating_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_ratings as application log lines (value STRING, event_id).

    purchase/click events carry the rating payload; other events become
    lines without the prefix.
    """
    er = event_ratings(spark, sf_dir, with_type=True)
    head = F.concat(F.lit("2024-01-01 INFO --- [http-nio-8088-exec-"),
                    (F.col("event_id") % 10).cast("string"),
                    F.lit("] ratings.api(line: 123) : "))
    line = F.when(F.col("event_type").isin("purchase", "click"),
                  F.concat(head, format_rating_event(prefix=RATING_LOG_PREFIX)))
    other = F.concat(head, F.lit("event "), F.col("event_type"), F.lit(" user "),
                     F.col("userId").cast("string"))
    return er.select(F.coalesce(line, other).alias("value"), "event_id")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(userId, productId, real, pred) with pred = product's average score."""
    r = ratings(spark, sf_dir)
    avg = r.groupBy("productId").agg(F.avg("score").alias("pred"))
    return r.select("userId", "productId", F.col("score").alias("real")) \
            .join(avg, "productId")
