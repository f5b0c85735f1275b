"""Request-time reads of the warehouse (the original's web endpoints).

Every list is precomputed by ``plans.jobs.serving_views_job`` already joined
with product details and average scores and clustered by its request key, so
a request is one scan whose key filter is pushed to parquet (files and row
groups outside the key's min/max range are skipped).  The online lists are
read from the StreamRecs deltas, which the streaming sink writes already
hydrated, newest batch per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recspark.functions.expr import user_id_from_name
from recspark.plans.jobs import read, stream_recs


def hot(spark: SparkSession, wh: str, num: int = 6) -> DataFrame:
    """/hot: recently popular products."""
    order = [F.col("yearmonth").desc(), F.col("count").desc(), F.col("productId").asc()]
    top = read(spark, wh, "ServeHot").orderBy(*order).limit(num)
    top = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # num rows
    # a product listed for several months keeps its best rank
    best = F.min("rank").over(Window.partitionBy("productId"))
    return top.withColumn("_best", best).where(F.col("rank") == F.col("_best")).drop("_best")


def rate(spark: SparkSession, wh: str, num: int = 6) -> DataFrame:
    """/rate: most-rated products."""
    order = [F.col("count").desc(), F.col("productId").asc()]
    top = read(spark, wh, "ServeRate").orderBy(*order).limit(num)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # num rows


def info(spark: SparkSession, wh: str, product_id: int) -> DataFrame:
    """/info/{id}: one product with its average score (no row if absent)."""
    return read(spark, wh, "ServeInfo").where(F.col("productId") == product_id)


def similar(spark: SparkSession, wh: str, view: str, product_id: int,
            num: int | None = None) -> DataFrame:
    """/itemcf/{id} (view ServeItemCF), /contentbased/{id} (ServeContentBased)."""
    r = read(spark, wh, view).where(F.col("itemId") == product_id)
    return r if num is None else r.where(F.col("rank") <= num)


def search(spark: SparkSession, wh: str, pattern: str) -> DataFrame:
    """/search: products whose name matches an unanchored regular expression."""
    return read(spark, wh, "ServeInfo").where(F.col("name").rlike(pattern))


def user_id(spark: SparkSession, wh: str, username: str) -> int | None:
    """The id of a registered name: a name's id is its hash, so one bucket of
    User is read."""
    spot = spark.createDataFrame([(username,)], "username string").select(user_id_from_name(F.col("username"))).first()[0]
    row = read(spark, wh, "User", spot).where(F.col("username") == username).select("userId").first()
    return row and row["userId"]


def offline(spark: SparkSession, wh: str, user_id: int | None, num: int | None = None) -> DataFrame:
    """/offline: a user's ALS list."""
    r = read(spark, wh, "ServeOffline").where(F.col("userId") == F.lit(user_id).cast("int"))
    return r if num is None else r.where(F.col("rank") <= num)


def offline_of(spark: SparkSession, wh: str, username: str, num: int | None = None) -> DataFrame:
    """/offline by name: the list of a registered user."""
    return offline(spark, wh, user_id(spark, wh, username), num)


def stream(spark: SparkSession, wh: str, user_id: int | None) -> DataFrame:
    """/stream: a user's online list (deltas are stored hydrated)."""
    if user_id is None:
        return stream_recs(spark, wh, details=True).limit(0)
    return stream_recs(spark, wh, user_id, details=True)


def stream_of(spark: SparkSession, wh: str, username: str) -> DataFrame:
    """/stream by name."""
    return stream(spark, wh, user_id(spark, wh, username))
