"""Rating table updates and recent-rating queues (batch form)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.constants import RECENT_QUEUE_SIZE, RECENT_READ_N


def apply_ratings(current: DataFrame, new: DataFrame, mode: str = "upsert",
                  order: str | None = None) -> DataFrame:
    """Merge new ratings into the Rating table.

    ``upsert``: one row per (userId, productId) holding the latest score and
    the earliest ts (an update only sets the score).  ``append``: both rows
    stay (the original's effective behaviour).  New rows come after current
    ones; within each side ``order`` (default ``ts``) decides, then ts, then
    the score, so the result is one whatever the order's type.  A NULL new
    score is a score: it replaces the old one.
    """
    cols = ["userId", "productId", "score", "ts"]
    if mode == "append":
        return current.select(*cols).unionByName(new.select(*cols))
    if mode != "upsert":
        raise ValueError(f"unknown mode {mode!r}")
    o = order or "ts"

    def side(df, tag):
        # the score travels in a struct, so a NULL score is still a value
        return df.groupBy("userId", "productId").agg(
            F.max_by(F.struct("score"), F.struct(F.col(o).alias("o"), "ts", "score")).alias(f"s{tag}"),
            F.min("ts").alias(f"t{tag}"))

    both = side(current, 0).join(side(new, 1), ["userId", "productId"], "full")
    return both.select("userId", "productId", F.coalesce("s1", "s0")["score"].alias("score"),
                       F.least("t0", "t1").alias("ts"))


def recent_ratings(ratings: DataFrame, n: int = RECENT_READ_N,
                   queue_size: int = RECENT_QUEUE_SIZE,
                   order: str = "ts") -> DataFrame:
    """Newest-first per-user queue: keep ``queue_size``, read the first ``n``.

    Output (userId, rank, productId, score), rank 1 = newest.  Repeats of a
    product are kept, as in the queue.  The window limit is planned as a
    WindowGroupLimit, so a very active user is cut to n rows per map task
    before the shuffle.
    """
    keep = min(n, queue_size)
    # ties of the order go to the larger product, then the larger score
    w = Window.partitionBy("userId").orderBy(F.col(order).desc(), F.col("productId").desc(), F.col("score").desc())
    return (ratings.select("userId", "productId", "score", order)
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= keep)
            .select("userId", F.col("rank").cast("int").alias("rank"),
                    "productId", "score"))
