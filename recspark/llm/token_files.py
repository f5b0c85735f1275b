"""Token-id files: documents in ascending doc_id order, range-coded.

A file set is a folder of Parquet files that Spark writes and commits, so a
lost task is run again and never leaves half a file.  Each row is one frame
(part, frame, start, data): ``part`` and ``frame`` give the order, ``start``
counts the ids of the part before the frame.  ``data`` is (little endian)

    documents (u32); per document: has a doc_id (u8), doc_id (i64), ids (u64)
    payload of ``rangecoder``: all ids of the frame's documents in order

A frame holds whole documents, up to about ``FRAME`` ids (more if one document
is longer); inside it every block of ``rangecoder.BLOCK`` ids is coded from an
empty model and has its own checksum.  Ranges of doc_id are dealt to parts by
one range partitioning, which breaks ties by the text, so rows that share a
doc_id spread as well; tasks hold one frame at a time.

Edge cases: a null or empty text is its end id alone; a null doc_id comes
first; repeated rows are written as often as they occur; texts of any length
stay whole; an empty table gives no frame; other columns are ignored.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recspark.llm import rangecoder
from recspark.llm.common import small_batches, texts
from recspark.llm.tokens import KIND, encoder
from recspark.session import scratch_path

END = 2
FRAME = 1 << 21
SCHEMA = "part int, frame int, start long, n_ids long, data binary"


def _frame(rows: list[tuple[int | None, bytes]]) -> tuple[bytes, int]:
    head = struct.pack("<I", len(rows)) + b"".join(
        struct.pack("<BqQ", d is not None, d or 0, len(ids) // 4) for d, ids in rows)
    ids = np.frombuffer(b"".join(ids for _, ids in rows), "<u4")
    return head + rangecoder.encode(ids), len(ids)


def _unframe(data: bytes):
    """(doc_id, ids) of a frame's documents."""
    n = struct.unpack_from("<I", data)[0]
    index = [struct.unpack_from("<BqQ", data, 4 + 17 * i) for i in range(n)]
    ids, at = rangecoder.decode(data[4 + 17 * n:]), 0
    for known, d, size in index:
        yield d if known else None, ids[at:at + size]
        at += size


def _write(path: str | None, end: int, frame_ids: int):
    def run(batches):
        part, frame, start = TaskContext.get().partitionId(), 0, 0
        closing, rows, held = np.array([end], "<u4").tobytes(), [], 0

        def flush():
            nonlocal frame, start, rows, held
            data, n = _frame(rows)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([frame], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([n], pa.int64()), pa.array([data], pa.binary())], names=["part", "frame", "start", "n_ids", "data"])
            frame, start, rows, held = frame + 1, start + n, [], 0
            return out

        for b in small_batches(batches, limit=2 << 20, held=KIND):
            for d, ids in zip(b.column(0).to_pylist(), encoder(path).encode(texts(b))):
                rows.append((d, ids + closing))
                held += len(ids) // 4 + 1
                if held >= frame_ids:
                    yield flush()
        if rows:
            yield flush()
    return run


def write_ids(docs: DataFrame, to: str, path: str | None = None, end: int = END, frame_ids: int = FRAME) -> None:
    """Write the ids of every document of ``docs`` to the folder ``to``."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .withColumn("th", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "th")
               .sortWithinPartitions("doc_id", "th").select("doc_id", "text"))
    ordered.mapInArrow(_write(path, end, frame_ids), SCHEMA).write.parquet(to)


def _read(batches):
    for b in batches:
        for start, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            rows = []
            for d, ids in _unframe(data):
                rows.append((d, start, len(ids), ids.tobytes()))
                start += len(ids)
            for i in range(0, len(rows), 1000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows[i:i + 1000]), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["doc_id", "start", "n_tokens", "ids"])


def read_ids(spark: SparkSession, at: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids of each
    document in the folder."""
    frames = spark.read.schema(SCHEMA).parquet(at)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per part
    parts = (frames.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    return (frames.join(F.broadcast(parts), "part")  # as many rows as files
            .select((F.col("start") + F.col("first")).alias("start"), "data")
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids binary"))


def token_files(docs: DataFrame) -> DataFrame:
    to = scratch_path(docs.sparkSession, "ids")
    write_ids(docs, to)
    return read_ids(docs.sparkSession, to)
