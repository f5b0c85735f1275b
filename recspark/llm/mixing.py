"""Mixing sources to target weights: hash-random order, distributed prefix
sums of sizes, exact cut at each source's budget, epochs where it needs more.

* Sources (by code point, null last) weigh 5, 2, 1, 5, 2, 1, ...  Together
  they share ``share`` of all sizes; a target stops at ``most`` times its
  source's size and the excess goes to the others by weight.  So every target
  is min(most * size, level * weight) with one common level, found by water
  filling over the table of sources (one row per source).
* Inside a source, rows are ordered by an md5 key of their doc_id (rows that
  share a key by size, then by place; equal rows are interchangeable).  One
  range partitioning over (source, key) splits a hot source over many tasks;
  a running sum inside each partition plus the sums of the partitions before
  it (one row per partition and source) is the prefix sum.
* A budget of ``e`` times the source's size and a rest takes every row ``e``
  times, and once more the rows before the rest's cut; the row on the cut is
  taken in part, so a source's taken words are exactly its budget.

Edge cases: a null or empty text has size 0 and nothing is taken of it; a
source whose texts are all empty has target 0; null sources form one source;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recspark.llm.common import WORD, cut

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix-1"


def words(col: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = SHARE,
            most: int = MOST) -> list[tuple[str | None, int, float]]:
    """(source, size, target) by water filling."""
    ranked = sorted(sizes, key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8", "surrogatepass")))
    rows = [(s, n, weights[i % len(weights)]) for i, (s, n) in enumerate(ranked)]
    left, weight, level = share * sum(n for _, n, _ in rows), sum(w for *_, w in rows), 0.0
    for _, n, w in sorted(rows, key=lambda r: most * r[1] / r[2]):
        level = left / weight
        if most * n >= level * w:
            break
        left, weight = left - most * n, weight - w
    return [(s, n, round(min(float(most * n), level * w), 6)) for s, n, w in rows]


def _running(batches):
    """Sum of the sizes before each row within its run of one source, over a
    partition that is sorted by source."""
    source, total = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        sid = b.column(b.schema.get_field_index("sid")).to_numpy(zero_copy_only=False)
        size = b.column(b.schema.get_field_index("size")).to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.cumsum(size) - size
        start = np.flatnonzero(np.r_[True, sid[1:] != sid[:-1]])
        base = before[start] - (total if source == sid[0] else 0) * (np.arange(len(start)) == 0)
        local = before - np.repeat(base, np.diff(np.r_[start, len(sid)]))
        source, total = sid[-1], int(local[-1] + size[-1])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(local)], names=[*b.schema.names, "local"])


def mix(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, share: float = SHARE, most: int = MOST,
        keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (and the columns of
    ``keep``) for every row of ``docs``."""
    spark = docs.sparkSession
    rows = cut(docs.select(
        "doc_id", "source", words().alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"),
        F.monotonically_increasing_id().alias("place"), *keep))
    sizes = [(r["source"], r["size"]) for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    table = spark.createDataFrame(
        [(i, s, n, t) for i, (s, n, t) in enumerate(targets(sizes, weights, share, most))],
        "sid long, source string, source_size long, target double")
    known = rows.join(table.select("sid", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (known.repartitionByRange(parts, "sid", "key", "size", "place")
             .sortWithinPartitions("sid", "key", "size", "place"))
    schema = dealt.schema.simpleString()[len("struct<"):-1]
    ordered = cut(dealt.mapInArrow(_running, f"{schema},local:bigint").withColumn("part", F.spark_partition_id()))
    before = W.partitionBy("sid").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (ordered.groupBy("sid", "part").agg(F.sum("size").alias("n"))
               .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    placed = ordered.join(offsets, ["sid", "part"]).join(table.drop("source"), "sid")
    budget = F.floor(F.col("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size") - F.col("offset") - F.col("local")
    return placed.select(
        "doc_id", "source", "size", "source_size", "target",
        (epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(rest, F.col("size")))).alias("taken"),
        *keep)


# md5 keys and water filling in DuckDB: the level is the largest that any
# set of capped sources allows (min of lines, solved line by line)
SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-1' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
s AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS w FROM s0),
l AS (SELECT a.source, (SELECT (1.5 * (SELECT sum(source_size) FROM s)
        - coalesce(sum(2 * b.source_size) FILTER (2 * b.source_size * a.w < 2 * a.source_size * b.w), 0))
        / sum(b.w) FILTER (2 * b.source_size * a.w >= 2 * a.source_size * b.w) FROM s b) AS level FROM s a),
t AS (SELECT source, source_size, round(least(2.0 * source_size, (SELECT max(level) FROM l) * w)::DOUBLE, 6) AS target FROM s),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY key, d.size ROWS UNBOUNDED PRECEDING)::BIGINT - d.size AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
    + greatest(0, least(budget % source_size - before, size)) END::BIGINT AS taken FROM p
"""
