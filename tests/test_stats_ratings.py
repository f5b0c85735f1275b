from conftest import rows
from recspark.operators import ratings as R
from recspark.operators import stats as ST

RS = "userId int, productId int, score double, ts bigint"


def test_statistics(spark):
    df = spark.createDataFrame([(1, 10, 4.0, 1556409600), (2, 10, 2.0, 1556409600),
                                (3, 11, 5.0, 1554076800), (4, None, 1.0, 1554076800)], RS)
    assert rows(ST.rate_more_products(df)) == [(10, 2), (11, 1)]
    # grouped by (month, product): the original's GROUP BY yearmonth only is invalid
    assert rows(ST.rate_more_recently_products(df)) == [(10, 2, 201904), (11, 1, 201904)]
    avg = {r.productId: r.avg for r in ST.average_products(df).collect()}
    assert avg[10] == 3.0 and avg[11] == 5.0
    assert ST.user_item_space(df).first().n_pairs == 4 * 2


def test_upsert_and_append(spark):
    old = spark.createDataFrame([(1, 7, 2.0, 100)], RS)
    new = spark.createDataFrame([(1, 7, 4.5, 200)], RS)
    assert rows(R.apply_ratings(old, new)) == [(1, 7, 4.5, 100)]
    assert rows(R.apply_ratings(old, new, mode="append")) == [(1, 7, 2.0, 100), (1, 7, 4.5, 200)]


def test_recent_queue_bounds(spark):
    df = spark.createDataFrame([(1, i, 1.0 + i % 5, 1000 + i) for i in range(45)], RS)
    q = R.recent_ratings(df, n=21)
    got = rows(q, "rank", "productId")
    assert len(got) == 21 and got[0] == (1, 44) and got[-1] == (21, 24)
    assert R.recent_ratings(df, n=100).count() == 40


def test_window_limit_planned(spark):
    df = spark.createDataFrame([(1, i, 1.0, i) for i in range(10)], RS)
    plan = R.recent_ratings(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_one_pass_statistics_equal_separate(spark):
    df = spark.createDataFrame([(u, p, float(1 + (u * p) % 5), 1554076800 + 86400 * 20 * ((u + p) % 4))
                                for u in range(7) for p in range(5)], RS)
    rm, rr, av = ST.statistics_tables(df)
    assert rows(rm) == rows(ST.rate_more_products(df))
    assert rows(rr) == rows(ST.rate_more_recently_products(df))
    a = {k: v for k, v in rows(av)}
    b = {k: v for k, v in rows(ST.average_products(df))}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_upsert_numeric_order_path_equals_struct_path(spark):
    from pyspark.sql import functions as F
    cur = spark.createDataFrame([(1, 7, 2.0, 100), (1, 7, 3.0, 150), (2, 8, 1.0, 50), (3, 9, 4.0, 70)], RS)
    new = spark.createDataFrame([(1, 7, 4.5, 200), (1, 7, 5.0, 300), (4, 1, 2.5, 10)], RS)
    fast = R.apply_ratings(cur, new, order="ts")
    slow = R.apply_ratings(cur.withColumn("o", F.struct("ts")), new.withColumn("o", F.struct("ts")), order="o")
    assert rows(fast) == rows(slow) == [(1, 7, 5.0, 100), (2, 8, 1.0, 50), (3, 9, 4.0, 70), (4, 1, 2.5, 10)]
