"""End-to-end: loader -> statistics -> offline -> similarity -> online stream."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import rows
from recspark.operators import online as O
from recspark.operators import stats as ST
from recspark.plans import jobs as J
from recspark.plans import serve as SRV
from recspark.sources import driver_tables as DT
from recspark.sources import files as IO

SF = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="recspark-jobs-")
    wh = os.path.join(root, "warehouse")
    IO.write_products_file(DT.products(spark, SF), os.path.join(root, "products"))
    IO.write_ratings_file(DT.ratings(spark, SF), os.path.join(root, "ratings"))
    J.data_loader_job(spark, os.path.join(root, "products"), os.path.join(root, "ratings"), wh)
    assert J.read(spark, wh, "Rating").count() == DT.ratings(spark, SF).count()

    J.statistics_job(spark, wh)
    assert rows(J.read(spark, wh, "RateMoreProducts")) == rows(ST.rate_more_products(DT.ratings(spark, SF)))

    J.offline_job(spark, wh, max_iter=3, product_top_k=10)
    recs = J.read(spark, wh, "UserRecs")
    assert recs.where(F.size("recs") > 20).count() == 0
    assert recs.selectExpr("explode(recs) AS r").where("r.score <= 0").count() == 0
    pr = J.read(spark, wh, "ProductRecs")
    assert pr.groupBy("productId").count().where("count > 10").count() == 0
    assert pr.where("productId = simProductId").count() == 0

    J.similarity_jobs(spark, wh, top_k=5)
    assert J.read(spark, wh, "ItemCFProductRecs").where("rank > 5").count() == 0

    # ready-to-serve views answer the endpoints with one filtered scan each
    J.serving_views_job(spark, wh)
    pid = J.read(spark, wh, "ItemCFProductRecs").agg(F.min("productId")).first()[0]
    uid = J.read(spark, wh, "UserRecs").agg(F.min("userId")).first()[0]
    assert SRV.info(spark, wh, pid).count() == 1 and SRV.info(spark, wh, -1).count() == 0
    assert [r.rank for r in SRV.rate(spark, wh, 6).orderBy("rank").collect()] == [1, 2, 3, 4, 5, 6]
    assert 0 < SRV.hot(spark, wh, 6).count() <= 6
    assert 0 < SRV.similar(spark, wh, "ServeItemCF", pid).count() <= 5
    assert SRV.offline(spark, wh, uid).where("rank > 20").count() == 0

    # online job: payload lines of the event ratings, two files = two batches
    src = os.path.join(root, "events")
    ev = DT.event_ratings(spark, SF).where(F.col("productId") < 200)
    (ev.select(F.concat_ws("|", "userId", "productId", "score", "ts").alias("value"))
       .repartitionByRange(2, "ts").write.text(src))
    q = J.online_job(spark, wh, os.path.join(root, "ckpt"),
                     {"fmt": "text", "path": src, "maxFilesPerTrigger": 1},
                     trigger={"availableNow": True}, min_sim=0.0)
    q.awaitTermination()
    got = J.stream_recs(spark, wh)
    exp = O.online_recs(ev, J.product_sims(spark, wh), min_sim=0.0, history=J.read(spark, wh, "Rating"))
    assert got.count() > 0
    assert rows(got.select("userId", "rank", "productId", F.round("score", 9))) == \
        rows(exp.select("userId", "rank", "productId", F.round("score", 9)))

    # a restart from the checkpoint with no new files changes nothing
    q = J.online_job(spark, wh, os.path.join(root, "ckpt"),
                     {"fmt": "text", "path": src, "maxFilesPerTrigger": 1},
                     trigger={"availableNow": True}, min_sim=0.0)
    q.awaitTermination()
    assert J.stream_recs(spark, wh).count() == got.count()
