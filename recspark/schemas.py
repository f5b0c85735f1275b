"""Schemas of the recommender's tables (one spelling: ``productId``)."""

from pyspark.sql import types as T

# The caret-separated product file: 7 string fields, 2 and 3 unused.
PRODUCT_FILE = T.StructType([
    T.StructField("productId", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("categoryIds", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("imageUrl", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("tags", T.StringType()),
])

PRODUCT = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("imageUrl", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("tags", T.StringType()),
])

# The comma-separated rating file; ts in epoch seconds.
RATING_FILE = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("productId", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

RATING = RATING_FILE

REC = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])

USER_RECS = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("recs", T.ArrayType(REC)),
])

PRODUCT_RECS = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("recs", T.ArrayType(REC)),
])

# Long (exploded) form of any rec list: key, 1-based rank, item, score.
SIM = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("simProductId", T.IntegerType()),
    T.StructField("sim", T.DoubleType()),
])

USER = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("username", T.StringType()),
    T.StructField("first", T.BooleanType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("prefGenres", T.ArrayType(T.StringType())),
])

RATE_MORE = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("count", T.LongType()),
])

RATE_MORE_RECENTLY = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("count", T.LongType()),
    T.StructField("yearmonth", T.IntegerType()),
])

AVERAGE = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("avg", T.DoubleType()),
])
