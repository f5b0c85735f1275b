"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import cut

PART = 1 << 18       # links that one partition holds


def components(links: DataFrame) -> DataFrame:
    """(a long, b long) links -> (id, root): every id of a link with the
    smallest id it reaches.

    A distributed union-find: each round links every node's larger neighbours
    to its smallest one (large star), then its smaller neighbours and itself
    to that one (small star), until the links no longer change, which takes a
    number of rounds logarithmic in the longest path.  Minima are combined
    before each shuffle, rounds are cut by a checkpoint, and only a count and
    a checksum reach the driver.  A round's links lie in as few partitions as
    hold them, so a few links don't leave a shuffle of many small files a round.
    """
    e = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        state = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == mark or not state[0]:
            break
        mark = state
        e = e.coalesce(-(-state[0] // PART))
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        e = cut(large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .union(low).distinct().coalesce(-(-2 * state[0] // PART)))
    return e.select(F.col("a").alias("id"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
