"""End-to-end jobs over a warehouse folder: the original's six programs.

Tables (one folder each under ``warehouse``): Product, Rating, RateMoreProducts,
RateMoreRecentlyProducts, AverageProducts, UserRecs, ProductRecs,
ItemCFProductRecs, ContentBasedProductRecs, StreamRecs (merge-on-read folder).
UserRecs (at most 20 per user) is stored nested (``recs ARRAY<STRUCT<productId,
score>>``); the similarity tables, whose lists are unbounded unless a top-k is
asked for, are stored long (productId, rank, simProductId, sim) so no list is
ever gathered into one row.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark import schemas
from recspark.constants import MAX_SIM_PRODUCTS, PRODUCT_SIM_THRESHOLD
from recspark.functions.expr import user_id_from_name

from recspark.operators import als as A
from recspark.operators import ratings as R
from recspark.operators import recs as RC
from recspark.operators import similarity as SIM
from recspark.operators import stats as ST
from recspark.operators import users as U
from recspark.session import checkpoint_dir
from recspark.sources import files as IO
from recspark.sources import versions as V
from recspark.streaming import online as STR


def _t(warehouse: str, name: str) -> str:
    return os.path.join(warehouse, name)


# tables that jobs update in place: versioned, in buckets of the user
VERSIONED = ("Rating", "User")


def read(spark: SparkSession, warehouse: str, name: str, key=None) -> DataFrame:
    """A table of the warehouse; with ``key``, one user's rows of a versioned one."""
    path = _t(warehouse, name)
    if name in VERSIONED and V.manifest(spark, path):
        return V.read(spark, path, key)
    rows = spark.read.parquet(path)
    return rows if key is None else rows.where(F.col("userId") == key)


def data_loader_job(spark: SparkSession, products_path: str, ratings_path: str,
                    warehouse: str) -> None:
    """Files -> Product (clustered by productId) and Rating (versioned, in buckets of userId)."""
    IO.table_layout(IO.load_products(spark, products_path), _t(warehouse, "Product"), "productId")
    V.create(IO.load_ratings(spark, ratings_path), _t(warehouse, "Rating"), "userId")


def statistics_job(spark: SparkSession, warehouse: str) -> None:
    """Rating -> the three statistics tables from one scan of the ratings."""
    ratings = read(spark, warehouse, "Rating")
    rate_more, recent, average = ST.statistics_tables(ratings)
    IO.write_table(rate_more, _t(warehouse, "RateMoreProducts"))
    IO.write_table(recent, _t(warehouse, "RateMoreRecentlyProducts"))
    IO.write_table(average, _t(warehouse, "AverageProducts"))


def offline_job(spark: SparkSession, warehouse: str, rank: int = 5, max_iter: int = 10,
                reg: float = 0.01, min_sim: float = PRODUCT_SIM_THRESHOLD,
                product_top_k: int | None = MAX_SIM_PRODUCTS, seed: int = 42,
                exclude_rated: bool = False, tuned: bool = False) -> None:
    """Rating -> ALS -> UserRecs (top 20 positive; rated products kept unless
    ``exclude_rated``) and ProductRecs (factor cosine).  ``tuned`` takes rank and
    lambda from the tuner's winner."""
    ratings = read(spark, warehouse, "Rating")
    if tuned:
        best = read(spark, warehouse, "ALSTuning").orderBy("rmse", "rank", "lambda").first()
        rank, reg = best["rank"], best["lambda"]
    model = A.als_fit(ratings, rank, max_iter, reg, seed)
    user_recs = A.als_user_recs(model, exclude_rated=ratings if exclude_rated else None)
    IO.table_layout(RC.pack_recs(user_recs, "userId"), _t(warehouse, "UserRecs"), "userId")
    pairs = A.als_product_recs(model, min_sim=min_sim, top_k=product_top_k)
    IO.table_layout(_ranked(pairs), _t(warehouse, "ProductRecs"), "productId")


def _ranked(pairs: DataFrame) -> DataFrame:
    r = RC.top_k_per_key(pairs, "productId", "simProductId", "sim", None)
    return r.select("productId", "rank", "simProductId", "sim")


def als_tuning_job(spark: SparkSession, warehouse: str, **grid) -> DataFrame:
    """Rating -> (rank, lambda, rmse) per grid point, best first, also kept as ALSTuning."""
    train, test = A.random_split(read(spark, warehouse, "Rating"))
    IO.write_table(A.als_grid_search(spark, train, test, **grid), _t(warehouse, "ALSTuning"))
    return read(spark, warehouse, "ALSTuning").orderBy("rmse")


def similarity_jobs(spark: SparkSession, warehouse: str, top_k: int | None = MAX_SIM_PRODUCTS) -> None:
    """Rating -> ItemCFProductRecs; Product -> ContentBasedProductRecs.  Lists
    hold the ``top_k`` most similar products (None: all of them)."""
    for name, pairs in (("ItemCFProductRecs", SIM.item_cf(read(spark, warehouse, "Rating"), top_k=top_k)),
                        ("ContentBasedProductRecs",
                         SIM.content_based(read(spark, warehouse, "Product"), top_k=top_k))):
        IO.table_layout(_ranked(pairs), _t(warehouse, name), "productId")


def product_sims(spark: SparkSession, warehouse: str, table: str = "ProductRecs") -> DataFrame:
    """A stored similarity table as (productId, simProductId, sim)."""
    return read(spark, warehouse, table).select("productId", "simProductId", "sim")


def _update(spark: SparkSession, warehouse: str, name: str, new: DataFrame, merge, schema, notes: dict | None = None) -> None:
    """``merge(old, new)`` for the buckets of the users in ``new``; the rest of the
    table keeps its files, and the new version is switched to at the end."""
    path = _t(warehouse, name)
    if V.manifest(spark, path) is None:  # the first update, or a plain folder of files
        try:
            old = spark.read.schema(schema).parquet(path)
            checkpoint_dir(spark)
            old = old.checkpoint()
        except AnalysisException:
            old = spark.createDataFrame([], schema)
        V.create(old, path, "userId")
    checkpoint_dir(spark)
    V.update(spark, path, new.checkpoint(), merge, notes)


def ratings_job(spark: SparkSession, warehouse: str, new: DataFrame, mode: str = "upsert", notes: dict | None = None) -> None:
    """New ratings (userId, productId, score, ts) -> Rating, so that the
    statistics, ALS, item-CF and online jobs see them."""
    _update(spark, warehouse, "Rating", new, lambda old, new: R.apply_ratings(old, new, mode=mode), schemas.RATING, notes)


def logged_ratings_job(spark: SparkSession, warehouse: str, mode: str = "upsert") -> tuple[int, int] | None:
    """What the online job has logged since the last call -> Rating.  How far the
    log has been read is switched together with the table, so each batch's
    ratings arrive once, also when the driver is lost in between."""
    found = V.manifest(spark, _t(warehouse, "Rating"))
    mark = found and found["notes"].get("log")
    new, last = STR.stream_log(spark, _t(warehouse, "StreamRecs"), tuple(mark) if mark else None)
    if new is not None:
        ratings_job(spark, warehouse, new, mode, {"log": list(last)})
    return last


def users_job(spark: SparkSession, warehouse: str, requests: DataFrame | None = None,
              preferences: DataFrame | None = None) -> None:
    """Registrations (username, timestamp) and preference updates (userId,
    first, prefGenres) -> User.  A name's id is its hash, so a name that is
    registered already lies in the bucket of the request."""
    if requests is not None:
        named = requests.withColumn("userId", user_id_from_name(F.col("username")))
        _update(spark, warehouse, "User", named, lambda old, new: U.register_users(old, new.drop("userId")), schemas.USER)
    if preferences is not None:
        _update(spark, warehouse, "User", preferences, U.update_user_prefs, schemas.USER)


def log_processor_job(spark: SparkSession, checkpoint: str, source: dict, sink: dict,
                      trigger: dict | None = None):
    """Log topic -> rating payloads -> output topic (stateless, checkpointed)."""
    lines = STR.rating_stream_source(spark, **source)
    fmt = sink.pop("format", "kafka")
    path = sink.pop("path", None)
    return STR.start(STR.stream_log_filter(lines), fmt, path, checkpoint, trigger, **sink)


def online_job(spark: SparkSession, warehouse: str, checkpoint: str, source: dict,
               trigger: dict | None = None, min_sim: float = 0.4,
               k: int = MAX_SIM_PRODUCTS, hydrate: bool = False, compact_every: int | None = 10):
    """Rating events -> StreamRecs (merge-on-read folder under the warehouse).

    ``hydrate`` stores the deltas joined with ServeInfo (``serving_views_job``)
    so a /stream request is one filtered scan.

    The similarity lists are written once in long form for the stream, so
    each micro-batch joins a table instead of a driver-held map.  Users' queues
    and rated products are keyed state, which a new checkpoint starts from the
    Rating table and the log of earlier runs; ``logged_ratings_job`` takes the
    batches' ratings into Rating.
    """
    sims_path, root = _t(warehouse, "ProductSimsLong"), _t(warehouse, "StreamRecs")
    IO.write_table(product_sims(spark, warehouse), sims_path)
    events = STR.stream_rating_parse(STR.rating_stream_source(spark, **source))
    run = STR.stream_run(spark, checkpoint, root)
    state = STR.user_state(events, before=STR.state_before(spark, root, read(spark, warehouse, "Rating")))
    writer = STR.StreamRecsWriter(root, sims_path, k=k, min_sim=min_sim, run=run, compact_every=compact_every,
                                  hydrate_with=_t(warehouse, "ServeInfo") if hydrate else None)
    return STR.start(state, None, None, checkpoint, trigger, "update", foreach_batch=writer)


def serving_views_job(spark: SparkSession, warehouse: str) -> None:
    """Ready-to-serve tables: every list already joined with product details
    and average scores, clustered by its request key, so a request is one
    filtered scan that skips files and row groups outside the key.

    ServeInfo (productId), ServeRate (count), ServeHot (yearmonth), ServeItemCF and
    ServeContentBased (itemId), ServeOffline (userId).  Rebuilt after the
    statistics / offline / similarity jobs.
    """
    from recspark.operators import serving as SV
    products, averages = read(spark, warehouse, "Product"), read(spark, warehouse, "AverageProducts")
    info = SV.hydrate_products(products.select("productId").withColumn("rank", F.lit(1)),
                               products, averages, rec_score=None)
    IO.table_layout(info, _t(warehouse, "ServeInfo"), "productId")
    # popularity is stored whole and unranked: a request orders and limits it
    IO.table_layout(SV.hydrate_products(read(spark, warehouse, "RateMoreProducts"), products, averages, rec_score=None),
                    _t(warehouse, "ServeRate"), "count", "productId")
    IO.table_layout(SV.hydrate_products(read(spark, warehouse, "RateMoreRecentlyProducts"), products, averages,
                                        rec_score=None), _t(warehouse, "ServeHot"), "yearmonth", "productId")
    for src, dst in (("ItemCFProductRecs", "ServeItemCF"),
                     ("ContentBasedProductRecs", "ServeContentBased")):
        recs = read(spark, warehouse, src).select(
            F.col("productId").alias("itemId"), "rank",
            F.col("simProductId").alias("productId"), F.col("sim").alias("score"))
        IO.table_layout(SV.hydrate_products(recs, products, averages), _t(warehouse, dst), "itemId")
    user_recs = RC.unpack_recs(read(spark, warehouse, "UserRecs"), "userId")
    IO.table_layout(SV.hydrate_products(user_recs, products, averages),
                    _t(warehouse, "ServeOffline"), "userId")


def online_replay_job(spark: SparkSession, warehouse: str, ratings: DataFrame,
                      min_sim: float = 0.4, k: int = MAX_SIM_PRODUCTS) -> None:
    """Batch replay of the online job over a whole rating log, written in the
    StreamRecs layout (as run 0, which no stream overwrites, hydrated like the stream's deltas), e.g. to
    seed it before a stream starts.  Needs ServeInfo (``serving_views_job``)."""
    from recspark.operators.online import online_recs
    recs = online_recs(ratings, product_sims(spark, warehouse), min_sim=min_sim, k=k,
                       history=read(spark, warehouse, "Rating"))
    recs = STR.hydrate_delta(recs, read(spark, warehouse, "ServeInfo"))
    IO.table_layout(recs, os.path.join(_t(warehouse, "StreamRecs"), "recs", "run=0", "batch_id=0"), "userId")


def stream_recs(spark: SparkSession, warehouse: str, user_id: int | None = None, details: bool = False) -> DataFrame:
    return STR.read_stream_recs(spark, _t(warehouse, "StreamRecs"), user_id, details)
