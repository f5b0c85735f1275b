"""Sketches of large sets keep pairs apart that 2,048 bits can't."""

import random

import numpy as np

from recspark.llm import jaccard_join as J
from recspark.llm.common import mix64


def bits(x):
    return sum(bin(int(w) & (1 << 64) - 1).count("1") for w in x)


def test_sketches_of_large_sets(spark):
    rnd = np.random.default_rng(1)
    pool = mix64(np.arange(30_000, dtype=np.uint64))
    pairs = []
    for n, left, new in [(100, 5, 5), (2000, 100, 150), (2100, 150, 0), (5000, 1500, 1500), (9000, 1000, 0), (9000, 3000, 3000)]:
        x = rnd.choice(pool[:20_000], n, replace=False)
        pairs.append((np.sort(x), np.sort(np.concatenate([x[left:], pool[20_000:20_000 + new]]))))
    rows = spark.createDataFrame([(i, *(list(map(int, J._sketch(s))) for s in p)) for i, p in enumerate(pairs)],
                                 "i long, sa array<long>, sb array<long>")
    found = {r.i: r.d for r in rows.select("i", J._differ("sa", "sb").alias("d")).collect()}
    fits = []
    for i, (x, y) in enumerate(pairs):
        unlike = len(np.setxor1d(x, y))
        assert found[i] <= unlike and found[i] % 2 == unlike % 2
        fits.append((100 + J.PERCENT) * found[i] <= (100 - J.PERCENT) * (len(x) + len(y)))
    assert fits == [True, True, True, False, True, False]  # with 2,048 bits the last one passes
    assert {len(J._sketch(x)) for x, _ in pairs} == {32, 64, 128, 256}
    folded = rows.withColumnRenamed("sa", "sketch").select("i", *J._folded()).collect()
    for r in folded:
        words = J._sketch(pairs[r.i][0])
        assert [r[f"f{j}"] for j in range(J.FOLD)] == [int(np.bitwise_xor.reduce(words[j::J.FOLD])) for j in range(J.FOLD)]


def test_long_texts_are_linked_across_sketch_sizes(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    base = rnd.choices(words, k=2100)                     # 2,096 shingles: 4,096 bits; shorter ones have 2,048
    docs = [(1, " ".join(base)), (2, " ".join(base[:1950])), (3, " ".join(base[:1500])), (4, " ".join(rnd.choices(words, k=2100)))]
    docs += [(10 + i, " ".join(base[:1900] + [f"x{i}-{j}" for j in range(100 + i)])) for i in range(12)]
    rows = J.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == {1: 1, 2: 1, 3: 3, 4: 4, **{10 + i: 1 for i in range(12)}}
