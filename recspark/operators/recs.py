"""Rec lists: per-key top-k, and the nested <-> long forms.

The long form ``(key, rank, productId, score)`` is canonical; the nested
``recs ARRAY<STRUCT<productId, score>>`` form is what serving tables store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Scores are ranked on a rounded value so float noise from different sum
# orders cannot reorder ties; ties then break on the item id.
RANK_DIGITS = 9


def rank_order(score: str, item: str):
    return [F.round(F.col(score), RANK_DIGITS).desc_nulls_last(), F.col(item).asc()]


def top_k_per_key(df: DataFrame, key: str, item: str = "productId",
                  score: str = "score", k: int | None = 20,
                  rank_col: str = "rank") -> DataFrame:
    """Keep each key's k best items (score desc, id asc) and number them.

    ``row_number() <= k`` right after the window lets Spark plan a
    WindowGroupLimit: every map task keeps only its local k per key before the
    shuffle, so a key with a third of all rows ships k rows per task.
    """
    w = Window.partitionBy(key).orderBy(*rank_order(score, item))
    out = df.withColumn(rank_col, F.row_number().over(w))
    if k is not None:
        out = out.where(F.col(rank_col) <= k)
    return out


def pack_recs(df: DataFrame, key: str, item: str = "productId",
              score: str = "score", rank: str = "rank") -> DataFrame:
    """Long -> nested: one row per key with ``recs`` in rank order.

    Intended for bounded lists (after ``top_k_per_key``): each key's list is
    built in one task.
    """
    packed = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(
        F.col(rank).alias("r"), F.col(item).cast("int").alias("productId"),
        F.col(score).cast("double").alias("score")))).alias("recs"))
    return packed.select(key, F.transform("recs", lambda x: F.struct(
        x["productId"].alias("productId"), x["score"].alias("score"))).alias("recs"))


def unpack_recs(df: DataFrame, key: str, recs: str = "recs", item: str = "productId",
                score: str = "score") -> DataFrame:
    """Nested -> long: (key, rank 1.., item, score); name the item column
    differently when the key is itself a product id."""
    return (df.select(key, F.posexplode(recs).alias("pos", "rec"))
              .select(key, (F.col("pos") + 1).cast("int").alias("rank"),
                      F.col("rec.productId").alias(item),
                      F.col("rec.score").alias(score)))
