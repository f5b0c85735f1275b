from conftest import rows
from recspark.operators import recs as RC
from recspark.operators import serving as SV
from recspark.operators import users as U


def test_pack_unpack_round_trip(spark):
    long = spark.createDataFrame([(1, 1, 5, 0.9), (1, 2, 6, 0.8), (2, 1, 7, 0.5)],
                                 "userId int, rank int, productId int, score double")
    packed = RC.pack_recs(long, "userId")
    assert packed.schema["recs"].dataType.simpleString() == "array<struct<productId:int,score:double>>"
    assert rows(RC.unpack_recs(packed, "userId")) == rows(long)


def test_top_k_ties_and_bound(spark):
    df = spark.createDataFrame([(1, p, 1.0) for p in (5, 3, 4)] + [(2, 9, 2.0)],
                               "userId int, productId int, score double")
    t = rows(RC.top_k_per_key(df, "userId", k=2), "userId", "rank", "productId")
    assert t == [(1, 1, 3), (1, 2, 4), (2, 1, 9)]


def test_hydrate_keeps_rank_and_defaults_score(spark):
    recs = spark.createDataFrame([(1, 10, 0.9), (2, 11, 0.8), (3, 99, 0.7)], "rank int, productId int, score double")
    prods = spark.createDataFrame([(10, "a", "u", "c", "t"), (11, "b", "u", "c", "t")],
                                  "productId int, name string, imageUrl string, categories string, tags string")
    avg = spark.createDataFrame([(10, 4.5)], "productId int, avg double")
    got = rows(SV.hydrate_products(recs, prods, avg), "rank", "productId", "recScore", "score")
    assert got == [(1, 10, 0.9, 4.5), (2, 11, 0.8, 0.0)]  # 99 not in catalog: dropped


def test_hot_recent_dedups_best_rank(spark):
    hot = spark.createDataFrame([(1, 5, 201905), (2, 4, 201905), (1, 9, 201904)],
                                "productId int, count bigint, yearmonth int")
    prods = spark.createDataFrame([(1, "a", "", "", ""), (2, "b", "", "", "")],
                                  "productId int, name string, imageUrl string, categories string, tags string")
    avg = spark.createDataFrame([], "productId int, avg double")
    assert rows(SV.hot_recent(hot, prods, avg, n=3), "rank", "productId") == [(1, 1), (2, 2)]


def test_register_users(spark):
    ex = spark.createDataFrame([(1, "old", True, 5, [])],
                               "userId int, username string, first boolean, timestamp bigint, prefGenres array<string>")
    rq = spark.createDataFrame([("old", 9), ("abc", 20), ("abc", 10)], "username string, timestamp bigint")
    out = rows(U.register_users(ex, rq), "userId", "username", "timestamp")
    assert out == [(1, "old", 5), (96354, "abc", 10)]


def test_update_prefs(spark):
    users = spark.createDataFrame([(1, "a", True, ["x"]), (2, "b", True, [])],
                                  "userId int, username string, first boolean, prefGenres array<string>")
    upd = spark.createDataFrame([(2, False, ["g1", "g2"])], "userId int, first boolean, prefGenres array<string>")
    got = rows(U.update_user_prefs(users, upd), "userId", "first")
    assert got == [(1, True), (2, False)]
