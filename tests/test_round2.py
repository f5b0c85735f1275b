"""Fixes of the second round: sessions, loaders, writes, hot rows, seeds."""

import os
import subprocess
import sys
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from recspark.operators import ratings as R
from recspark.operators import similarity as SIM
from recspark.operators import users as U
from recspark.plans import jobs as J
from recspark.sources import files as IO

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RATING = "userId int, productId int, score double, ts bigint"


@pytest.mark.parametrize("kind", ["unset", "path", "uri"])
def test_checkpoint_folder(kind):
    d = tempfile.mkdtemp(prefix="recspark-conf-")
    conf = {"unset": "", "path": f"{d}/ck", "uri": f"file://{d}/ck"}[kind]
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
b = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1")
b = b.config("spark.checkpoint.dir", {conf!r}) if {conf!r} else b
spark = b.getOrCreate()
import __spark_entry__ as E
n = E.queries()["distinct_users"](spark, "/root/testdata/sf0.001").count()
from recspark.session import checkpoint_dir, clean_scratch, scratch_path
spark.range(3).write.parquet(scratch_path(spark, "x"))
spark.range(3).checkpoint().count()
assert checkpoint_dir(spark).startswith({conf!r}), checkpoint_dir(spark)
print("DONE", n, clean_scratch(spark))
"""
    env = dict(os.environ, SPARK_CONF_DIR=d) if kind == "unset" else dict(os.environ)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=d, env=env, timeout=300)
    assert "DONE" in out.stdout and out.stdout.strip().endswith("1"), out.stderr[-2000:]
    assert not os.path.exists(os.path.join(d, "file:"))


def test_loaders_reject_bad_lines(spark):
    d = tempfile.mkdtemp(prefix="recspark-load-")
    with open(f"{d}/r.csv", "w") as f:
        f.write("1,2,3.5,100\nbad,line,x,y\n4,5\n")
    assert rows(IO.load_ratings(spark, f"{d}/r.csv")) == [(1, 2, 3.5, 100)]
    assert IO.load_ratings(spark, f"{d}/r.csv", with_corrupt=True).where("_corrupt_record is not null").count() == 2
    with open(f"{d}/p.txt", "w") as f:
        f.write("+5^\tname ^x^y^u^c^a|b\n")
    assert rows(IO.load_products(spark, f"{d}/p.txt")) == [(5, "name", "u", "c", "a|b")]


def test_null_fields_keep_their_places(spark):
    p = spark.createDataFrame([(1, None, "u", "c", "t")], "productId int, name string, imageUrl string, categories string, tags string")
    d = tempfile.mkdtemp(prefix="recspark-null-")
    IO.write_products_file(p, f"{d}/p")
    assert rows(IO.load_products(spark, f"{d}/p")) == [(1, "", "u", "c", "t")]


def test_apply_ratings_same_for_any_order_type(spark):
    cur = spark.createDataFrame([(1, 7, 2.0, 100), (2, 7, 1.0, 50)], RATING)
    new = spark.createDataFrame([(1, 7, 4.0, 200), (1, 7, 4.5, 200), (2, 7, None, 60), (3, 1, 5.0, 1)], RATING)
    want = [(1, 7, 4.5, 100), (2, 7, None, 50), (3, 1, 5.0, 1)]
    for order in ("n", "s"):
        c, n = (df.withColumn("n", F.col("ts")).withColumn("s", F.struct("ts")) for df in (cur, new))
        got = sorted(map(tuple, R.apply_ratings(c, n, order=order).collect()))
        assert got == want


def test_preferences_do_not_multiply_users(spark):
    users = spark.createDataFrame([(1, "a", True, 0, [])], "userId int, username string, first boolean, timestamp bigint, prefGenres array<string>")
    upd = spark.createDataFrame([(1, False, ["x"], 1), (1, False, ["y"], 2)], "userId int, first boolean, prefGenres array<string>, at int")
    got = U.update_user_prefs(users, upd, order="at").collect()
    assert len(got) == 1 and got[0].prefGenres == ["y"]


def test_gram_does_not_depend_on_blocks(spark):
    """A signed matrix with one hot row and a cancelled pair."""
    rng = np.random.default_rng(3)
    n_rows, n_cols = 48, 60
    m = np.zeros((n_rows, n_cols))
    m[0] = rng.normal(size=n_cols)  # a third of the entries and more
    for r in range(1, n_rows):
        m[r, rng.choice(n_cols, 3, replace=False)] = rng.normal(size=3)
    m[5], m[6] = 0, 0
    m[5, :2], m[6, :2] = (1, 1), (1, -1)
    df = spark.createDataFrame([(int(r), int(c), float(m[r, c])) for r, c in zip(*np.nonzero(m))], "r int, c int, v double")
    g = m @ m.T
    want = {(a, b) for a in range(n_rows) for b in range(n_rows) if a != b and abs(g[a, b]) > 1e-12}
    best = {(a, b) for a in range(n_rows) for b in sorted((b for x, b in want if x == a), key=lambda b: (-round(g[a, b], 9), b))[:4]}
    for target in (15, 60, 10 ** 6):
        kw = {"row_block": 4, "target_group_entries": target}
        got = {(a, b): d for a, b, d in SIM.sparse_gram(df, "r", "c", "v", **kw).collect()}
        assert got.keys() == want and all(abs(got[k] - g[k]) < 1e-9 for k in want)
        assert {(a, b) for a, b, _ in SIM.sparse_gram(df, "r", "c", "v", top_k=4, **kw).collect()} == best


def test_ratings_and_users_reach_the_warehouse(spark):
    wh = tempfile.mkdtemp(prefix="recspark-wh-")
    spark.createDataFrame([(1, 7, 2.0, 100)], RATING).write.parquet(f"{wh}/Rating")
    J.ratings_job(spark, wh, spark.createDataFrame([(1, 7, 4.0, 200), (2, 7, 2.0, 5)], RATING))
    J.statistics_job(spark, wh)
    assert rows(J.read(spark, wh, "AverageProducts")) == [(7, 3.0)]
    J.users_job(spark, wh, spark.createDataFrame([("abc", 1)], "username string, timestamp bigint"))
    J.users_job(spark, wh, preferences=spark.createDataFrame([(96354, False, ["x"])], "userId int, first boolean, prefGenres array<string>"))
    assert [tuple(r) for r in J.read(spark, wh, "User").collect()] == [(96354, "abc", False, 1, ["x"])]
