"""Two-pass external shuffle into shards.

Pass 1 scatters records uniformly into buckets of a size that fits a task's
memory, by a seeded hash of each record's place (not of its content, so a
third of all rows being copies of one record are spread as evenly as any
others).  Pass 2 puts a bucket's records into canonical order, runs a seeded
Fisher-Yates shuffle over them and deals them out: bucket by bucket the
records have consecutive positions, and position p goes to shard
``p mod shards``, slot ``p div shards``.  Shard sizes in rows thus differ by
one at most (law ``rows``), slots are gapless, and no step needs more than one
bucket in memory.  ``write_shards`` writes a folder per shard.

The bucket sizes are counted before pass 2 (one row per bucket); a lost task
of either pass is simply run again, since the rows are written down with their
places first (both the counts and pass 2 read those) and every order is seeded.

Edge cases: null texts have size 1; null or repeated doc_ids, ties and equal
rows are dealt like any others; an empty table gives empty shards; input
columns named ``shard`` or ``slot`` are replaced, any others are carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.llm.common import fresh, numbered
from recspark.session import scratch_path

SHARDS = 8
BUCKET_BYTES = 32 << 20
SEED = 20241


def _shuffle(seed: int, offsets: dict[int, int], shards: int, hidden: tuple[str, str, str]):
    """Pass 2 for one bucket."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column(hidden[0])[0].as_py()
        table = table.sort_by([(c, "ascending") for c in hidden[1:]])
        at = np.random.default_rng([seed, bucket]).permutation(table.num_rows)  # Fisher-Yates
        pos = offsets[bucket] + np.arange(table.num_rows)
        return (table.drop_columns(list(hidden)).take(pa.array(at))
                .append_column("shard", pa.array((pos % shards).astype(np.int32)))
                .append_column("slot", pa.array(pos // shards)))
    return run


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
          text: str = "text") -> DataFrame:
    """Every row of ``docs`` with its ``shard`` and ``slot``, which replace
    input columns of these names."""
    docs = docs.drop("shard", "slot")
    rows, row = numbered(docs)
    bucket, place = fresh("_bucket", rows), fresh("_place", rows)
    total = rows.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64)).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    placed = rows.withColumn(place, F.xxhash64(row, F.lit(seed)))
    dealt = placed.withColumn(bucket, F.pmod(F.col(place), F.lit(buckets)).cast("int"))
    count = {r[0]: r[1] for r in dealt.groupBy(bucket).agg(F.count("*")).collect()}
    offsets, at = {}, 0
    for b in sorted(count):
        offsets[b], at = at, at + count[b]
    schema = T.StructType([*docs.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    return (dealt.groupBy(bucket).applyInArrow(_shuffle(seed, offsets, shards, (bucket, place, row)), schema))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write ``path/shard=K/...``; a shard's order is its ``slot``."""
    shard(docs, **options).write.partitionBy("shard").parquet(path)


def sharded(docs: DataFrame) -> DataFrame:
    """doc_id, text, shard, slot, read back from the written shards."""
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    rows = docs.select("doc_id", "text")
    write_shards(rows, path)
    schema = T.StructType([*rows.schema.fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)
