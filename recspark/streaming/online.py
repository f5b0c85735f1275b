"""Structured Streaming form of the log processor and online recommender.

* ``rating_stream_source``: Kafka topic (or any streaming source) -> ``value``.
* ``stream_log_filter`` / ``stream_rating_parse``: stateless projections.
* ``user_state``: per user, the queue of newest ratings and the set of rated
  products in the RocksDB state store (``transformWithState``).
* ``stream_recent_state``: the queue of ``user_state`` as an upsert stream.
* ``StreamRecsWriter``: ``foreachBatch`` sink over ``user_state`` that computes
  the lists of the batch's users; no log is read again.  Outputs are keyed by
  batch id, so a replayed batch overwrites its own output (exactly-once).
* ``read_stream_recs`` / ``compact_stream_recs``: lists are a versioned table
  plus the newer batches' deltas, which a compaction folds into it.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from recspark.constants import (MAX_SIM_PRODUCTS, RECENT_QUEUE_SIZE, RECENT_READ_N,
                                STREAM_SIM_THRESHOLD)
from recspark.functions.expr import filter_rating_logs, parse_rating_events
from recspark.operators.online import candidate_products, stream_scores
from recspark.operators.similarity import VectorSims
from recspark.session import checkpoint_dir
from recspark.sources import versions
from recspark.sources.files import replace_by_key


# ------------------------------------------------------------------ sources

def rating_stream_source(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                         topic: str = "recommender", servers: str | None = None,
                         starting_offsets: str = "latest", **options) -> DataFrame:
    """Streaming text events as one ``value`` column.

    Kafka: subscribe to ``topic``; the key/value bytes are cast to strings.
    Any other format (``text`` in tests) reads files under ``path``.
    """
    if fmt == "kafka":
        r = (spark.readStream.format("kafka")
             .option("subscribe", topic)
             .option("startingOffsets", starting_offsets))
        if servers:
            r = r.option("kafka.bootstrap.servers", servers)
        df = r.options(**options).load()
        return df.select(F.col("value").cast("string").alias("value"))
    r = spark.readStream.format(fmt).options(**options)
    return r.load(path).select(F.col("value").cast("string").alias("value"))


def stream_log_filter(lines: DataFrame) -> DataFrame:
    """Log lines -> rating payloads (stateless)."""
    return filter_rating_logs(lines, "value")


def stream_rating_parse(values: DataFrame) -> DataFrame:
    """Payload text -> (userId, productId, score, ts); malformed rows dropped."""
    return parse_rating_events(values, "value")


def start(df: DataFrame, fmt: str, path: str | None, checkpoint: str,
          trigger: dict | None = None, output_mode: str = "append",
          foreach_batch=None, **options):
    """Start a query with a checkpoint (always) and a trigger:
    ``{"processingTime": "2 seconds"}`` live, ``{"availableNow": True}`` to drain."""
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    w = w.trigger(**(trigger or {"processingTime": "2 seconds"}))
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    w = w.format(fmt).options(**options)
    return w.start(path) if path else w.start()


# ------------------------------------------------------------ state per user

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
RATING = "productId int, score double, ts bigint"
# kind: an entry of the queue (rank 1 = newest), a rated product, a rating of this batch
STATE_OUT = "userId int, version bigint, kind string, rank int, productId int, score double, ts bigint"
# what the processor gives for a user: the same as lists (queue, rated products, batch)
_USER_OUT = ("userId int, version bigint, q_p array<int>, q_s array<double>, q_ts array<bigint>, rated array<int>, "
             "b_p array<int>, b_s array<double>, b_ts array<bigint>")
_ENTRY = np.dtype([("ts", "<i8"), ("productId", "<i4"), ("score", "<f8")])
FOLD_ROWS = 10_000          # ratings of a user's batch that are folded at once


class UserState(StatefulProcessor):
    """A user's queue of the ``size`` newest ratings (by time, then the larger
    product, then the larger score, whatever their order of arrival), the set of
    rated products, and the number of ratings seen.

    The queue is bounded and each chunk of a batch is folded into it with a heap;
    the set is kept in pieces, and a batch adds one with the products that are
    new.  Every access of the state is a message to the JVM, so the queue is one
    packed value and a piece of the set another.  Output per batch and touched
    user: one row with the queue and, with ``whole``, the set and the batch's
    ratings.
    """

    def __init__(self, size: int, whole: bool):
        self.size, self.whole = size, whole

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getValueState("recent", "queue binary, n bigint")
        self.rated = handle.getListState("rated", "products binary")

    def _keep(self, newest: list, n: int) -> tuple[list, int]:
        """The queue with ``n`` more ratings, of which ``newest`` are the newest."""
        kept = self.recent.get()
        if kept is not None:
            newest = heapq.nlargest(self.size, np.frombuffer(bytes(kept[0]), _ENTRY).tolist() + newest)
            n += kept[1]
        self.recent.update((np.array(newest, _ENTRY).tobytes(), n))
        return newest, n

    def _add(self, products) -> None:
        if len(products):
            self.rated.appendValue((np.array(sorted(products), "<i4").tobytes(),))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Ratings from before the stream: those of an earlier run's log are
        queued, those of the Rating table are only rated."""
        if self.whole:
            self._add(initialState.products)
        if initialState.n:
            self._keep(list(zip(initialState.ts, initialState.p, initialState.s)), initialState.n)

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator[Row]:
        newest, n, batch, new = [], 0, [], set()
        while add := [(r.ts, r.productId, r.score) for r in itertools.islice(rows, FOLD_ROWS)]:
            newest = heapq.nlargest(self.size, newest + add)
            n += len(add)
            if self.whole:
                new.update(p for _, p, _ in add)
                batch += add
        newest, n = self._keep(newest, n)
        rated = []
        if self.whole:
            for (piece,) in self.rated.get():
                rated += np.frombuffer(bytes(piece), "<i4").tolist()
            new.difference_update(rated)
            self._add(new)
            rated += new
        (q_ts, q_p, q_s), (b_ts, b_p, b_s) = ([list(c) for c in zip(*x)] or [[], [], []] for x in (newest, batch))
        yield Row(userId=key[0], version=n, q_p=q_p, q_s=q_s, q_ts=q_ts, rated=rated, b_p=b_p, b_s=b_s, b_ts=b_ts)


def _starts(before: DataFrame, size: int) -> DataFrame:
    """``before`` as a row a user: products, and the newest ``size`` logged ratings of n."""
    logged = F.slice(F.sort_array(F.collect_list(F.when(F.col("logged"), F.struct("ts", "productId", "score"))), False), 1, size)
    # a user with a row that has no product starts with no rated products, as ever (by the SQL the others would count)
    whole = F.count_if(F.col("productId").isNull()) == 0
    one = before.where("userId is not null").groupBy("userId").agg(
        F.when(whole, F.collect_set("productId")).otherwise(F.array().cast("array<int>")).alias("products"),
        logged.alias("l"), F.count_if("logged").alias("n"))
    return one.select("userId", "products", "n", F.col("l.ts").alias("ts"), F.col("l.productId").alias("p"), F.col("l.score").alias("s"))


def user_state(events: DataFrame, queue_size: int = RECENT_QUEUE_SIZE, whole: bool = True,
               before: DataFrame | None = None) -> DataFrame:
    """Ratings (userId, productId, score, ts) -> STATE_OUT rows of the users of
    each micro-batch.  ``before`` (userId, productId, score, ts, logged) is what
    the state of a new checkpoint starts from.  Rows without user, product,
    score or time don't arrive here (``stream_rating_parse`` drops them)."""
    events.sparkSession.conf.set(PROVIDER, ROCKSDB)
    start_from = None if before is None else _starts(before, queue_size).groupBy("userId")
    users = (events.select("userId", "productId", "score", "ts").groupBy("userId")
             .transformWithState(UserState(queue_size, whole), _USER_OUT, "Update", "None", start_from))
    entry = "struct<kind:string,rank:int,productId:int,score:double,ts:bigint>"
    numbered = lambda kind, at, rank: F.transform(F.arrays_zip(f"{at}_p", f"{at}_s", f"{at}_ts"), lambda x, i: F.struct(
        F.lit(kind), (i + 1).cast("int") if rank else F.lit(None).cast("int"), x[f"{at}_p"], x[f"{at}_s"], x[f"{at}_ts"]).cast(entry))
    none = [F.lit(None).cast(t) for t in ("double", "bigint")]
    rated = F.transform("rated", lambda p: F.struct(F.lit("rated"), F.lit(None).cast("int"), p, *none).cast(entry))
    every = F.concat(numbered("recent", "q", True), rated, numbered("rating", "b", False))
    return users.select("userId", "version", F.explode(every).alias("x")).select("userId", "version", "x.*")


def stream_recent_state(events: DataFrame, queue_size: int = RECENT_QUEUE_SIZE) -> DataFrame:
    """Per-user queue of the newest ``queue_size`` ratings, as upserts: the
    whole queue of every user touched in a micro-batch, tagged with a version
    (ratings seen so far); state and output per user are bounded by the queue."""
    return user_state(events, queue_size, whole=False).drop("kind")


class RecentQueues:
    """``foreachBatch`` sink of ``stream_recent_state``: a versioned table of the
    users' current queues.  A batch replaces its users' rows and notes its
    number with them, so a replayed one changes nothing."""

    def __init__(self, root: str, n_buckets: int = versions.N_BUCKETS):
        self.root, self.n_buckets = root, n_buckets

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        checkpoint_dir(spark)
        found = versions.manifest(spark, self.root)
        if found is None:
            versions.create(batch, self.root, "userId", self.n_buckets, {"batch": batch_id})
        elif found["notes"]["batch"] < batch_id:
            versions.update(spark, self.root, batch.checkpoint(), lambda old, new: replace_by_key(old, new, "userId"),
                            {"batch": batch_id})


def read_recent_queues(spark: SparkSession, root: str, read_n: int = RECENT_QUEUE_SIZE, user_id: int | None = None) -> DataFrame:
    """Current queues (userId, rank, productId, score), newest first."""
    return (versions.read(spark, root, user_id).where(F.col("rank") <= read_n)
            .select("userId", "rank", "productId", "score"))


# ------------------------------------------------------------ StreamRecs sink

# stored lists: recScore is the list's own score; the product's details and average score may be missing
STORED = ("userId int, rank int, productId int, recScore double, name string, imageUrl string, categories string, "
          "tags string, score double")
COLUMNS = [c.split()[0] for c in STORED.split(", ")]


class StreamRecsWriter:
    """``foreachBatch`` body over ``user_state`` maintaining StreamRecs.

    Layout under ``root``: ``log/run=R/batch_id=N`` the batch's ratings;
    ``recs/run=R/batch_id=N`` the new lists of the batch's users (a NULL-rank
    tombstone for a user whose list became empty); ``base`` a versioned table of
    the lists that ``compact_stream_recs`` has folded.  The state gives the
    users' queues and rated products, so a batch costs what its users do: it
    reads no log, no Rating table and no earlier list, and only the similarity
    lists are joined.  A batch replayed after a failure overwrites its folders.
    ``run`` numbers the checkpoints that have fed this folder (``stream_run``):
    a new one starts again at batch 0 but comes after all batches before it,
    and run 0 is a seed written by a batch job.  Every ``compact_every`` batches
    the deltas are folded (None: never).
    """

    def __init__(self, root: str, sims: DataFrame | VectorSims | str, recent_n: int = RECENT_READ_N,
                 k: int = MAX_SIM_PRODUCTS, min_sim: float = STREAM_SIM_THRESHOLD,
                 hydrate_with: str | None = None, run: int = 1, compact_every: int | None = 10):
        self.root, self.sims_src, self.run = root, sims, run
        self.recent_n, self.k, self.min_sim = recent_n, k, min_sim
        self.hydrate_with = hydrate_with  # a ServeInfo table: deltas stored ready to serve
        self.compact_every = compact_every
        self._sims = None

    def sims(self, spark: SparkSession) -> DataFrame | VectorSims:
        # static for the life of the query: read once, kept in executor
        # memory/disk (a lost block is re-read from its files)
        if self._sims is None:
            s = spark.read.parquet(self.sims_src) if isinstance(self.sims_src, str) else self.sims_src
            self._sims = s.persist()
        return self._sims

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        at = f"run={self.run}/batch_id={batch_id}"
        state = batch.persist()
        try:
            ratings = state.where("kind = 'rating'").select("userId", "productId", "score", "ts")
            ratings.write.mode("overwrite").parquet(f"{self.root}/log/{at}")
            recents = state.where((F.col("kind") == "recent") & (F.col("rank") <= self.recent_n))
            triggers = recents.where("rank = 1").select("userId", "productId")
            rated = state.where("kind = 'rated'").select("userId", "productId")
            candidates = candidate_products(triggers, self.sims(spark), rated, self.k)
            recs = stream_scores(candidates, recents.select("userId", "rank", "productId", "score"), self.sims(spark),
                                 min_sim=self.min_sim)
            if self.hydrate_with:
                recs = hydrate_delta(recs, spark.read.parquet(self.hydrate_with))
            else:
                recs = recs.withColumnRenamed("score", "recScore").select(
                    *COLUMNS[:4], *[F.lit(None).cast("double" if c == "score" else "string").alias(c) for c in COLUMNS[4:]])
            # used twice (rows and tombstones): at most k rows per batch user.  A
            # checkpoint, as the second use doesn't find a kept plan and forms them again
            checkpoint_dir(spark)
            recs = recs.checkpoint(eager=True)
            tomb = triggers.select("userId").join(recs.select("userId"), "userId", "left_anti")
            for f in recs.schema.fields:
                if f.name != "userId":
                    tomb = tomb.withColumn(f.name, F.lit(None).cast(f.dataType))
            recs.unionByName(tomb).write.mode("overwrite").parquet(f"{self.root}/recs/{at}")
        finally:
            state.unpersist()
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            compact_stream_recs(spark, self.root)


def stream_log(spark: SparkSession, root: str, after: tuple[int, int] | None = None) -> tuple[DataFrame | None, tuple]:
    """The ratings that streams have logged after a (run, batch), and the last one's."""
    folders = _batches(spark, f"{root}/log", after)
    if not folders:
        return None, after
    paths = [f"{root}/log/run={r}/batch_id={b}" for r, b in folders]
    return spark.read.schema("userId int, " + RATING).parquet(*paths), folders[-1]


def state_before(spark: SparkSession, root: str, history: DataFrame | None) -> DataFrame | None:
    """What a new checkpoint's state starts from: the log of earlier runs and
    the Rating table's products."""
    log, _ = stream_log(spark, root)
    parts = [] if log is None else [log.withColumn("logged", F.lit(True))]
    if history is not None:
        parts.append(history.select("userId", "productId", F.lit(None).cast("double").alias("score"),
                                    F.lit(None).cast("bigint").alias("ts"), F.lit(False).alias("logged")).distinct())
    return parts[0].union(parts[1]) if len(parts) == 2 else parts[0] if parts else None


def stream_run(spark: SparkSession, checkpoint: str, root: str) -> int:
    """The run number of a checkpoint: kept beside it, and one more than any
    run in the folder when the checkpoint is new."""
    from pyspark.errors import AnalysisException
    mark = f"{checkpoint.rstrip('/')}-run"
    try:
        return spark.read.schema("run int").parquet(mark).first()[0]
    except AnalysisException:
        pass
    runs = [r for r, _ in _batches(spark, f"{root.rstrip('/')}/recs")]
    last = max([0, *runs, *(_mark(versions.manifest(spark, f"{root.rstrip('/')}/base")) or ())[:1]])
    spark.createDataFrame([(last + 1,)], "run int").write.parquet(mark)
    return last + 1


def hydrate_delta(recs: DataFrame, serve_info: DataFrame) -> DataFrame:
    """Join new lists with product details and average score (ServeInfo)."""
    from recspark.operators.serving import hydrate_products
    info = serve_info.join(recs.select("productId").distinct(), "productId", "left_semi")
    return hydrate_products(recs, info.drop("score", "rank"),
                            info.select("productId", F.col("score").alias("avg")))


def _batches(spark: SparkSession, folder: str, after: tuple[int, int] | None = None) -> list[tuple[int, int]]:
    """(run, batch) of the finished batch folders after a mark, in order; after
    compaction there are few."""
    found = []
    for run in versions.names(spark, folder):
        for batch in versions.names(spark, f"{folder}/{run}"):
            at = (int(run.split("=")[1]), int(batch.split("=")[1])) if "=" in run and "=" in batch else None
            if at and (after is None or at > after) and "_SUCCESS" in versions.names(spark, f"{folder}/{run}/{batch}"):
                found.append(at)
    return sorted(found)


def _deltas(spark: SparkSession, root: str, folders: list[tuple[int, int]]) -> DataFrame:
    """Rows of delta folders under one schema, whatever each of them holds."""
    return (spark.read.schema(STORED + ", run int, batch_id int").option("basePath", f"{root}/recs")
            .parquet(*[f"{root}/recs/run={r}/batch_id={b}" for r, b in folders]))


def _mark(found: dict | None) -> tuple[int, int] | None:
    return tuple(found["notes"]["mark"]) if found else None


def _newest(deltas: DataFrame) -> DataFrame:
    batch = F.struct("run", "batch_id")
    return (deltas.withColumn("_last", F.max(batch).over(Window.partitionBy("userId")))
            .where(batch == F.col("_last")).drop("_last", "run", "batch_id"))


def read_stream_recs(spark: SparkSession, root: str, user_id: int | None = None, details: bool = False) -> DataFrame:
    """Current StreamRecs (userId, rank, productId, score): the folded lists, and
    in their place those of users with newer deltas (the newest one's; a
    tombstone drops).  With ``user_id`` that user's bucket is read, and the filter
    is pushed to the deltas' scan.  ``details`` gives the columns of STORED."""
    base = f"{root}/base"
    found = versions.manifest(spark, base)
    folders = _batches(spark, f"{root}/recs", _mark(found))
    now = versions.read(spark, base, user_id) if found else spark.createDataFrame([], STORED)
    if folders:
        deltas = _deltas(spark, root, folders)
        new = _newest(deltas if user_id is None else deltas.where(F.col("userId") == user_id))
        now = now.join(new.select("userId").distinct(), "userId", "left_anti").select(*COLUMNS).unionByName(
            new.where(F.col("rank").isNotNull()))
    return now if details else now.select("userId", "rank", "productId", F.col("recScore").alias("score"))


def compact_stream_recs(spark: SparkSession, root: str, n_buckets: int = versions.N_BUCKETS) -> dict | None:
    """Fold the deltas into the versioned table: only buckets of users with new
    lists are written, and table and mark switch together.  Deltas folded by the
    compaction before go; those folded now stay for readers that hold them."""
    base = f"{root}/base"
    found = versions.manifest(spark, base)
    before = _mark(found)
    folders = _batches(spark, f"{root}/recs", before)
    if not folders:
        return found
    new = _newest(_deltas(spark, root, folders)).select(*COLUMNS)
    notes = {"mark": list(folders[-1])}
    if found is None:
        found = versions.create(new.where(F.col("rank").isNotNull()), base, "userId", n_buckets, notes)
    else:
        checkpoint_dir(spark)
        new = new.checkpoint()
        found = versions.update(spark, base, new, lambda old, new: replace_by_key(
            old, new.where(F.col("rank").isNotNull()), "userId", keys=new), notes)
    for r, b in _batches(spark, f"{root}/recs"):
        if before is not None and (r, b) <= before:
            versions.delete(spark, f"{root}/recs/run={r}/batch_id={b}")
    return found
