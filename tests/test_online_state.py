"""Versioned tables, the online job's keyed state, its store and its way to Rating."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recspark.operators import online as O
from recspark.plans import jobs as J
from recspark.plans import serve as SRV
from recspark.sources import files as IO
from recspark.sources import versions as V
from recspark.streaming import online as STR

RATING = "userId int, productId int, score double, ts bigint"
SIMS = "productId int, simProductId int, sim double"


def ratings(spark, data):
    return spark.createDataFrame(data, RATING)


def files_of(root):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(f"{root}/data") for f in fs if f.startswith("part-")}


def test_update_writes_only_its_buckets(spark):
    root = tempfile.mkdtemp(prefix="recspark-ver-") + "/t"
    V.create(ratings(spark, [(u, 1, 1.0, u) for u in range(100)]), root, "userId", n_buckets=8)
    before = files_of(root)
    found = V.update(spark, root, ratings(spark, [(3, 9, 5.0, 1)]), lambda old, new: old.unionByName(new), {"upto": 7})
    assert len({v for v in found["buckets"].values() if v == 2}) == 1 and found["notes"] == {"upto": 7}
    new = files_of(root) - before
    assert new and len({os.path.dirname(f) for f in new}) == 1  # one bucket's folder
    assert V.read(spark, root).count() == 101
    assert rows(V.read(spark, root, 3)) == [(3, 1, 1.0, 3), (3, 9, 5.0, 1)]
    assert V.read(spark, root, version=1).count() == 100  # readers of the version before
    assert rows(V.read(spark, root, 12345)) == []


def test_lost_writer_leaves_the_old_table(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="recspark-ver-") + "/t"
    V.create(ratings(spark, [(u, 1, 1.0, u) for u in range(20)]), root, "userId", n_buckets=4)

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(V, "_commit", lost)
        with pytest.raises(KeyboardInterrupt):
            V.update(spark, root, ratings(spark, [(1, 1, 9.0, 9)]), lambda old, new: new)
    assert V.read(spark, root).count() == 20 and V.manifest(spark, root)["version"] == 1
    V.update(spark, root, ratings(spark, [(1, 1, 9.0, 9)]), lambda old, new: IO.replace_by_key(old, new, "userId"))
    assert rows(V.read(spark, root, 1)) == [(1, 1, 9.0, 9)] and V.read(spark, root).count() == 20


def test_old_versions_go_and_emptied_buckets_too(spark):
    root = tempfile.mkdtemp(prefix="recspark-ver-") + "/t"
    V.create(ratings(spark, [(u, 1, 1.0, u) for u in range(8)]), root, "userId", n_buckets=2)
    for i in range(5):
        V.update(spark, root, ratings(spark, [(0, 1, float(i), i)]), lambda old, new: IO.replace_by_key(old, new, "userId"))
    assert len(os.listdir(f"{root}/manifest")) <= 2 * V.KEEP  # with the checksum files
    assert len([n for n in os.listdir(f"{root}/data") if n.startswith("v=")]) <= V.KEEP + 1
    every = V.read(spark, root).checkpoint()
    V.update(spark, root, every, lambda old, new: old.limit(0))
    assert V.read(spark, root).count() == 0 and V.manifest(spark, root)["buckets"] == {}


def test_layout_spreads_a_hot_key(spark):
    d = tempfile.mkdtemp(prefix="recspark-hot-")
    df = spark.range(8000).select(F.when(F.col("id") < 7200, 202401).otherwise(202300).alias("m"), F.col("id").cast("int").alias("p"))
    IO.table_layout(df, f"{d}/t", "m", "p", n_files=8)
    size = [r[0] for r in spark.read.parquet(f"{d}/t").groupBy(F.input_file_name()).count().select("count").collect()]
    assert len(size) == 8 and max(size) < 2000
    files = spark.read.parquet(f"{d}/t").where("m = 202300").select(F.input_file_name()).distinct().count()
    assert files <= 2


def test_compaction_keeps_reads_and_bounds_folders(spark):
    root = tempfile.mkdtemp(prefix="recspark-store-") + "/StreamRecs"
    store = {}
    for n in range(24):
        user, other = n % 5, (n * 3) % 7
        new = {user: [(1, n, float(n))], other: []} if user != other else {user: [(1, n, float(n)), (2, n + 1, 0.5)]}
        out = [(u, r, p, s) for u, xs in new.items() for r, p, s in xs] + [(u, None, None, None) for u, xs in new.items() if not xs]
        spark.createDataFrame(out, "userId int, rank int, productId int, recScore double").write.parquet(
            f"{root}/recs/run=1/batch_id={n}")
        store |= new
        want = sorted((u, r, p, s) for u, xs in store.items() for r, p, s in xs)
        if n % 4 == 3:
            before = rows(STR.read_stream_recs(spark, root))
            STR.compact_stream_recs(spark, root, n_buckets=3)
            assert before == want == rows(STR.read_stream_recs(spark, root))
            one = rows(STR.read_stream_recs(spark, root, user_id=user))
            assert one == [r for r in want if r[0] == user]
    assert len(os.listdir(f"{root}/recs/run=1")) <= 8
    assert rows(STR.read_stream_recs(spark, root)) == want


def test_online_job_state_log_and_names(spark):
    """A seed, a stream, its restart, and a second checkpoint; batches reach
    Rating once; requests by name."""
    d = tempfile.mkdtemp(prefix="recspark-online-")
    wh = f"{d}/wh"
    sims = [(a, b, 0.5 + (a * b % 7) / 16) for a in range(1, 7) for b in range(1, 7) if a != b]
    spark.createDataFrame([(p, 1, s, v) for p, s, v in sims], "productId int, rank int, simProductId int, sim double").write.parquet(
        f"{wh}/ProductRecs")
    V.create(ratings(spark, [(8, 2, 4.0, 1), (96354, 6, 1.0, 1)]), f"{wh}/Rating", "userId", n_buckets=4)
    seed = spark.createDataFrame([(7, 1, 2, 1.0)], "userId int, rank int, productId int, recScore double")
    seed.write.parquet(f"{wh}/StreamRecs/recs/run=0/batch_id=0")
    J.users_job(spark, wh, spark.createDataFrame([("abc", 1), ("idle", 2)], "username string, timestamp bigint"))
    batches = [[(8, 1, 5.0, 10), (96354, 1, 2.0, 10)], [(8, 3, 4.0, 12), (8, 1, 1.0, 12)], [(96354, 2, 5.0, 9)], [(9, 4, 3.0, 20)]]

    def put(n):
        (ratings(spark, batches[n]).select(F.concat_ws("|", "userId", "productId", "score", "ts").alias("value"))
         .coalesce(1).write.text(f"{d}/in/{n}"))

    def drain(checkpoint):
        J.online_job(spark, wh, f"{d}/{checkpoint}", {"fmt": "text", "path": f"{d}/in/*", "maxFilesPerTrigger": 1},
                     trigger={"availableNow": True}, min_sim=0.0, compact_every=2).awaitTermination()

    def expected(events):
        out = O.online_recs(ratings(spark, events), J.product_sims(spark, wh), min_sim=0.0,
                            history=ratings(spark, [(8, 2, 4.0, 1), (96354, 6, 1.0, 1)]))
        return sorted([(7, 1, 2, 1.0), *((u, r, p, round(s, 9)) for u, r, p, s in out.collect())])

    def stored():
        return sorted((u, r, p, round(s, 9)) for u, r, p, s in J.stream_recs(spark, wh).collect())

    put(0), put(1)
    drain("ck1")
    assert stored() == expected(batches[0] + batches[1])
    assert J.logged_ratings_job(spark, wh) == (1, 1)
    put(2)
    drain("ck1")  # a restart: the state goes on
    assert stored() == expected(sum(batches[:3], []))
    drain("ck1")  # nothing new
    assert stored() == expected(sum(batches[:3], []))
    assert J.logged_ratings_job(spark, wh) == J.logged_ratings_job(spark, wh) == (1, 2)
    now = rows(J.read(spark, wh, "Rating"))
    assert now == [(8, 1, 1.0, 10), (8, 2, 4.0, 1), (8, 3, 4.0, 12), (96354, 1, 2.0, 10), (96354, 2, 5.0, 9), (96354, 6, 1.0, 1)]
    want = rows(J.stream_recs(spark, wh, 96354))
    got = SRV.stream_of(spark, wh, "abc")
    assert [(r.userId, r["rank"], r.productId, r.recScore) for r in got.orderBy("rank").collect()] == want and want
    assert SRV.stream_of(spark, wh, "idle").count() == 0 == SRV.stream_of(spark, wh, "nobody").count()
    assert STR.stream_run(spark, f"{d}/ck2", f"{wh}/StreamRecs") == 2  # a new checkpoint comes after all before


def test_new_checkpoint_starts_from_log_and_history(spark):
    d = tempfile.mkdtemp(prefix="recspark-ck-")
    root = f"{d}/StreamRecs"
    ratings(spark, [(8, 1, 5.0, 10), (8, 4, 2.0, 11)]).write.parquet(f"{root}/log/run=1/batch_id=0")
    before = STR.state_before(spark, root, spark.createDataFrame([(8, 2), (8, 2)], "userId int, productId int"))
    (spark.createDataFrame([("8|3|4.0|9",)], "value string").coalesce(1).write.text(f"{d}/in"))
    events = STR.stream_rating_parse(STR.rating_stream_source(spark, fmt="text", path=f"{d}/in"))
    out = []
    STR.start(STR.user_state(events, before=before), None, None, f"{d}/ck", {"availableNow": True}, "update",
              lambda b, _: out.extend(b.collect())).awaitTermination()
    assert [(r["rank"], r.productId) for r in out if r.kind == "recent"] == [(1, 4), (2, 1), (3, 3)]
    assert sorted(r.productId for r in out if r.kind == "rated") == [1, 2, 3, 4]
    assert {r.version for r in out} == {3}
