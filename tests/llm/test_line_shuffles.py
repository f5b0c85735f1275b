"""Line dedup and the union-find shuffle and compare what they need, no more."""

import random

from pyspark.sql import functions as F

from recspark.llm import line_dedup
from recspark.llm.common import maybe
from recspark.llm.components import components


def test_few_links_lie_in_few_partitions(spark):
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long").repartition(16)
        found = components(links)
        assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}
        assert found.rdd.getNumPartitions() <= 33  # 64 before: 32 of the links and 32 of the roots
        assert components(links.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_lines_of_the_head_s_group_are_not_compared(spark):
    crowd = spark.createDataFrame([(1, k, 10 if k < 15 else k) for k in range(10, 18)], "band long, key long, root long")
    root = {r.key: r.root for r in crowd.collect()}
    pairs = [tuple(r) for r in line_dedup._star(crowd, 1).collect()]
    assert pairs and all(root[a] != root[b] for a, b in pairs)
    head = {b for _, b in pairs}
    assert len(head) == 1 and {a for a, _ in pairs} == {k for k in root if root[k] != root[min(head)]}


def test_filter_keeps_every_wanted_row(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 7).alias("j"))
    wanted = rows.where("k % 100 = 3")
    kept = maybe(rows, wanted, "k", "j")
    assert kept.columns == rows.columns
    assert kept.join(wanted, ["k", "j"], "left_semi").count() == 50
    assert kept.count() < 100
    assert maybe(rows, rows.limit(0), "k").count() == 0


def test_window_sets_are_the_distinct_windows(spark):
    rnd = random.Random(5)
    lines = ["".join(rnd.choice("ab") for _ in range(n)) for n in (1, 11, 12, 13, 40, 400)] + ["a" * 100, "日本語" * 9]
    grams = [{x[i:i + 12] for i in range(len(x) - 11)} or {x} for x in lines]
    sets = line_dedup.window_sets(lines)
    assert [len(x) for x in sets] == [len(x) for x in grams]
    for x, a in zip(sets, grams):
        for y, b in zip(sets, grams):
            assert line_dedup._shared(x, y) == len(a & b)
