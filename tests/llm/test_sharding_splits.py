"""Shards of an input whose splits differ between the jobs."""

import tempfile

from recspark.llm import sharding


def test_splits_may_change_between_jobs(spark):
    d = tempfile.mkdtemp(prefix="shards-") + "/docs"
    spark.range(3000).selectExpr("id AS doc_id", "repeat(cast(id AS string), 20) AS text").repartition(6).write.parquet(d)
    out = sharding.shard(spark.read.parquet(d), shards=4, bucket_bytes=20_000)  # counts are taken here
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    try:
        for n in names:
            spark.conf.set(n, "1000")
        rows = out.select("doc_id", "shard", "slot").collect()
    finally:
        for n, v in zip(names, old):
            spark.conf.set(n, v)
    assert sorted(r.doc_id for r in rows) == list(range(3000))
    assert sorted((r.shard, r.slot) for r in rows) == [(k, i) for k in range(4) for i in range(750)]
