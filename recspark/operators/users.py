"""User table updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.expr import user_id_from_name


def register_users(existing: DataFrame, requests: DataFrame, order: str = "timestamp") -> DataFrame:
    """Batch registration.

    ``requests`` (username, timestamp ms[, order]): names already present are
    skipped; among repeated new names the first request (by ``order``) wins.
    New users get userId = Java string hash of the name, first = true and no
    preferred genres.  Returns the whole User table.
    """
    cols = ["userId", "username", "first", "timestamp", "prefGenres"]
    new = requests.join(existing.select("username"), "username", "left_anti")
    # first request per name by aggregation (map-side partial min_by), not a
    # window, so a name requested very often is pre-combined per task
    new = (new.groupBy("username")
              .agg(F.min_by("timestamp", F.struct(order, "timestamp")).alias("timestamp"))
              .select(user_id_from_name("username").alias("userId"), "username",
                      F.lit(True).alias("first"),
                      F.col("timestamp").cast("bigint").alias("timestamp"),
                      F.array().cast("array<string>").alias("prefGenres")))
    return existing.select(*cols).unionByName(new)


def update_user_prefs(users: DataFrame, updates: DataFrame, order: str | None = None) -> DataFrame:
    """Set ``first`` and ``prefGenres`` by userId; other users unchanged.  Of
    several updates of one user the last by ``order`` counts (without it the
    largest (first, prefGenres), so the result never depends on row order)."""
    last = [F.col(order)] if order else []
    u = (updates.groupBy("userId")
         .agg(F.max_by(F.struct("first", "prefGenres"), F.struct(*last, "first", "prefGenres")).alias("u"))
         .select("userId", F.col("u.first").alias("_first"), F.col("u.prefGenres").alias("_genres")))
    return (users.join(u, "userId", "left")
            .withColumn("first", F.coalesce(F.col("_first"), F.col("first")))
            .withColumn("prefGenres", F.coalesce(F.col("_genres"), F.col("prefGenres")))
            .drop("_first", "_genres"))
