from conftest import rows
from recspark.constants import RATING_LOG_PREFIX as P
from recspark.functions import expr as X


def java_hash(s: str) -> int:
    h = 0
    data = s.encode("utf-16-le")
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i:i + 2], "little")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def test_log_payload_cases(spark):
    lines = [f"x INFO : {P}1|2|5.0|9 ", "no prefix here", f"ends with {P}",
             f"{P} x {P}y", f"a {P}\t 7|8|1.5|3\x01"]
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    got = [r.value for r in X.filter_rating_logs(df).collect()]
    assert sorted(got) == sorted(["1|2|5.0|9", "x", "7|8|1.5|3"])


def test_parse_with_rejects(spark):
    df = spark.createDataFrame([("1|2|5.0|9",), ("a|2|5.0|9",), ("1|2",), ("4|5|2.5|1556436808000",)],
                               "value string")
    good, bad = X.parse_rating_events(df, with_rejects=True)
    assert rows(good) == [(1, 2, 5.0, 9), (4, 5, 2.5, 1556436808)]
    assert rows(bad) == [("1|2",), ("a|2|5.0|9",)]


def test_month_ts_score(spark):
    df = spark.createDataFrame([(1556409600, 10.0), (1556436808000, 1.0), (0, 7.0), (1, 5.35)],
                               "ts bigint, raw double")
    out = df.select(X.rating_month(X.normalize_ts("ts")).alias("m"),
                    X.normalize_score("raw").alias("s")).collect()
    assert [r.m for r in out] == [201904, 201904, 197001, 197001]
    assert [r.s for r in out] == [5.0, 0.5, 3.5, 2.68]


def test_name_hash(spark):
    names = ["abc", "", "polygenelubricants", "Customer#000000001", "中文", "a\U0001F600b"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.h for r in df.select(X.user_id_from_name("n").alias("h")).collect()]
    assert got == [java_hash(n) for n in names]
    assert got[:3] == [96354, 0, -2147483648]


def test_split_and_format(spark):
    df = spark.createDataFrame([(1, "a|b||c")], "productId int, tags string")
    assert rows(X.split_tags(df), "tag") == [("a",), ("b",), ("c",)]
    ev = spark.createDataFrame([(96354, 57272, 5.0, 1556436808)], "userId int, productId int, score double, ts bigint")
    assert ev.select(X.format_rating_event().alias("v")).first().v == f"{P}96354|57272|5.0|1556436808"


def test_sql_function(spark):
    X.register_sql_functions(spark)
    assert spark.sql("SELECT changeDate(1556409600) AS m").first().m == 201904


def test_session_helpers(spark):
    from recspark.session import checkpoint_dir, cluster_conf
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    c = cluster_conf(1000, 8, 100 * 2**40)
    assert int(c["spark.sql.shuffle.partitions"]) == 102400
    assert cluster_conf(2, 4)["spark.sql.shuffle.partitions"] == "24"
    import recspark
    assert callable(recspark.item_cf) and callable(recspark.online_recs)
