"""Session helpers.

Operators never create a session: they take DataFrames.  This module only
builds one for tests / bench and resolves the shared checkpoint folder.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC month/epoch arithmetic, ANSI semantics
# (bad casts raise unless `try_*` is used), adaptive re-planning with skew
# splitting, and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(executors: int, cores_per_executor: int,
                 input_bytes: int | None = None) -> dict:
    """Settings for a large cluster (the 100 TB target).

    Shuffles start with many partitions (one per GB of input, since pruning
    and partial aggregation shrink what is shuffled; at least 3 per core, at
    most 200k) and adaptive execution coalesces them towards 256 MB, splits
    skewed partitions (a key with a third of the rows becomes many tasks) and
    rebuilds joins from runtime sizes; a side is broadcast only when measured
    under 64 MB.  Scans split files into 256 MB tasks.  Runtime bloom filters
    from the selective side of a join prune the large side's rows early.
    """
    cores = executors * cores_per_executor
    parts = 3 * cores
    if input_bytes:
        parts = max(parts, min(input_bytes // (1 << 30), 200_000))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def get_session(master: str | None = None, app: str = "recspark",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster `master` stays None and spark-submit decides; tests pass
    ``local[N]``.  A checkpoint folder is set only when the cluster has not
    named one (``spark.checkpoint.dir``).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


# checkpoint folders made here, by application (only where none was named)
_OWN_DIRS: dict[str, str] = {}
_SCRATCH: dict[str, list[str]] = {}
_SHIPPED: set[str] = set()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    ``spark.checkpoint.dir`` names it (a plain path or any Hadoop URI).  Only
    a local-mode session without one gets a fresh temp folder of its own; a
    cluster must name a shared folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or _OWN_DIRS.get(sc.applicationId)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = _OWN_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="recspark-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder (URIs stay URIs)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_count(spark: SparkSession) -> int:
    """Scratch folders named so far: a mark for ``clean_scratch``."""
    return len(_SCRATCH.get(spark.sparkContext.applicationId, []))


def clean_scratch(spark: SparkSession, since: int = 0, keep: str | None = None) -> int:
    """Delete the scratch folders this application has made since a mark, but
    those whose name starts with ``keep``, through the file system that holds
    them; DataFrames that still read one become unreadable, so call it once
    their results are written."""
    sc = spark.sparkContext
    own = _SCRATCH.get(sc.applicationId, [])
    old = [p for p in own[since:] if not (keep and p.rsplit("/", 1)[1].startswith(keep))]
    gone = 0
    for p in old:
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        gone += bool(path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True))
    _SCRATCH[sc.applicationId] = own[:since] + [p for p in own[since:] if p not in old]
    return gone


def written(df: DataFrame, name: str) -> DataFrame:
    """A table in a new scratch folder, read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of plans that nothing refers to any more go: Spark
    removes them when the driver collects its garbage, which may be late."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ship_package(spark: SparkSession) -> None:
    """Make ``recspark`` importable in the Python workers of every executor.

    Functions sent to workers are pickled by reference to this package, so it
    is zipped once per application into a folder of the driver and handed to
    ``addPyFile``, which serves it to the executors.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="recspark-pyfiles-"), "recspark.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)
