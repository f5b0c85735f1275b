"""Inner-product search: all pairs in exact integer arithmetic are the measure."""

import numpy as np
import pytest

from recspark.operators import als as A
from recspark.operators import mips as M


def frame(spark, m, parts=3):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, f array<double>").repartition(parts)


def brute(U, V, k, low=0.0):
    s = U @ V.T
    return sorted((i, r + 1, j, float(s[i, j])) for i in range(len(U))
                  for r, j in enumerate(sorted((j for j in range(len(V)) if s[i, j] > low),
                                               key=lambda j: (-s[i, j], j))[:k]))


def rows(df):
    return sorted((r.a, r.rank, r.b, r.score) for r in df.collect())


@pytest.mark.parametrize("wave_bytes", [1, 1500, 1 << 20])
def test_equals_all_pairs_whatever_the_waves(spark, wave_bytes):
    rng = np.random.default_rng(7)
    U = rng.integers(-3, 4, (90, 4)).astype(float)      # small integers: many ties, zero vectors
    V = rng.integers(-3, 4, (70, 4)).astype(float) * rng.integers(1, 5, (70, 1))
    U[5] = 0
    got = rows(M.norm_top_k(frame(spark, U), frame(spark, V), 5, block=8, wave_bytes=wave_bytes))
    assert got == brute(U, V, 5)


def test_all_products_tied(spark):
    U, V = np.ones((6, 3)), np.ones((50, 3))
    assert rows(M.norm_top_k(frame(spark, U), frame(spark, V), 4, block=7, wave_bytes=300)) == brute(U, V, 4)


def test_equals_the_blocked_form(spark):
    rng = np.random.default_rng(3)
    left, right = frame(spark, rng.normal(size=(60, 5))), frame(spark, rng.normal(size=(40, 5)))
    got, want = (sorted((r.a, r.rank, r.b) for r in df.collect())
                 for df in (M.norm_top_k(left, right, 6, block=9), A.blocked_top_k(left, right, 6, block=16)))
    assert got == want


def test_unusable_vectors_and_empty_sides(spark):
    odd = spark.createDataFrame(
        [(1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [])],
        "id int, f array<double>")
    assert rows(M.norm_top_k(odd, odd, 3)) == [(1, 1, 1, 5.0)]
    none = odd.limit(0)
    assert rows(M.norm_top_k(none, odd, 3)) == rows(M.norm_top_k(odd, none, 3)) == []


def test_bounds_spare_most_products():
    rng = np.random.default_rng(1)
    U, V = rng.normal(size=(300, 5)), rng.normal(size=(20_000, 5))
    V *= rng.pareto(2, (len(V), 1)) + 0.05                # few long vectors, many short ones
    norm = np.sqrt((V * V).sum(axis=1))
    order = np.argsort(-norm)
    blocks = [(norm[at[0]], at, V[at]) for at in np.split(order, range(500, len(order), 500))]
    lists = M.Lists.of(len(U), 10)
    _, products = M.search(U, blocks, lists)
    s = U @ V.T
    best = np.argsort(-s, axis=1)[:, :10]
    assert (lists.ids == best).all()
    assert products < 0.2 * s.size


def test_users_are_not_shuffled(spark):
    rng = np.random.default_rng(5)
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 3)))],
                                 "id int, f array<double>")
    plan = M.norm_top_k(left, left, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
