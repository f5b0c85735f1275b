"""Exact maximum inner product search, for top lists from latent factors.

The left side (users) stays where it is: no row of it is copied or shuffled.
The right side (products) is range-sorted by falling norm and packed into
blocks.  A task reads the blocks in that order, and by Cauchy-Schwarz no
product of a block scores more than ``|user| * largest norm of the block``: a
user whose k-th score is above that bound is closed and takes no part in the
blocks that follow.

A task holds the right side in waves of at most ``wave_bytes``, each collected
and broadcast by itself, whatever the size of the table.  One wave is one
lazy pass over the users.  With more, a wave's open users are written to the
shared scratch folder with the lists they have, and the next wave reads only
those, until none is open.  The driver sees one row a block besides.

Every score is summed in one order of the dimensions (a matrix product only
screens), so equal vectors have equal scores wherever they lie, and ties go to
the smaller id.

Edge cases: vectors that are null, empty or hold null, NaN or infinite
components take no part; all others have one length (an error otherwise);
repeated left rows get a list each; repeated right rows are candidates each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.session import written as _written

BLOCK = 2048
WAVE_BYTES = 64 << 20
LEFT_ROWS = 512          # left rows multiplied at once
SLACK = 1e-9             # relative, of bounds and screens, far above rounding
NO_ID = np.iinfo(np.int64).max

_BLOCKS = "part int, seq int, top double, ids binary, f binary"
_STATE = "a int, f array<double>, ids array<bigint>, scores array<double>, open boolean"


def _norm(f: str) -> F.Column:
    return F.sqrt(F.aggregate(f, F.lit(0.0), lambda s, x: s + x * x))


def _vectors(df: DataFrame) -> DataFrame:
    """(id, f, norm) of the usable vectors; a null component makes the norm null."""
    return (df.select(F.col("id").cast("int").alias("id"), F.col("f").cast("array<double>").alias("f"))
            .where("size(f) > 0").withColumn("norm", _norm("f"))
            .where("norm < double('infinity')"))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _pack(block: int):
    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for whole in batches:
            for lo in range(0, whole.num_rows, block):
                b = whole.slice(lo, block)
                f = np.ascontiguousarray(_matrix(b.column(1), b.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                     pa.array([float(b.column(2)[0].as_py())]),
                     pa.array([np.asarray(b.column(0), dtype=np.int64).tobytes()]), pa.array([f.tobytes()])],
                    names=["part", "seq", "top", "ids", "f"])
                seq += 1
    return run


def norm_blocks(right: DataFrame, block: int = BLOCK) -> DataFrame:
    """The right side by falling norm, ``block`` rows at most in one: (part,
    seq) is its place, ``top`` its largest norm."""
    order = [F.desc("norm"), F.asc("id")]
    return (_vectors(right).repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(_pack(block), _BLOCKS))


@dataclass
class Lists:
    """The best k of some left rows so far, best first (-inf: free place)."""

    scores: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, rows: int, k: int) -> "Lists":
        return cls(np.full((rows, k), -np.inf), np.full((rows, k), NO_ID, np.int64))

    def merge(self, row: np.ndarray, score: np.ndarray, item: np.ndarray) -> None:
        """Take in (row, score, id) triples."""
        if not len(row):
            return
        k = self.scores.shape[1]
        touched = np.unique(row)
        r = np.concatenate([np.repeat(touched, k), row])
        s = np.concatenate([self.scores[touched].ravel(), score])
        i = np.concatenate([self.ids[touched].ravel(), item])
        at = np.lexsort((i, -s, r))
        r, s, i = r[at], s[at], i[at]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        keep = place < k
        self.scores[r[keep], place[keep]] = s[keep]
        self.ids[r[keep], place[keep]] = i[keep]


def search(users: np.ndarray, blocks, lists: Lists, min_score: float = 0.0) -> tuple[np.ndarray, int]:
    """Read blocks (top, ids, f), falling by top, into the users' lists.
    Returns which users are still open and how many products were formed."""
    k = lists.scores.shape[1]
    length = np.sqrt((users * users).sum(axis=1))
    left, products = np.arange(len(users)), 0
    for top, ids, f in blocks:
        reach = length[left] * top * (1 + SLACK)
        # a bound equal to the k-th score may still be a tie with a smaller id
        left = left[(reach > min_score) & (reach >= lists.scores[left, k - 1])]
        if not len(left):
            break
        for lo in range(0, len(left), LEFT_ROWS):
            rows = left[lo:lo + LEFT_ROWS]
            screen = users[rows] @ f.T
            products += screen.size
            floor = np.maximum(lists.scores[rows, k - 1], min_score)
            if f.shape[0] > k:  # the block's own k-th score is a floor too
                floor = np.maximum(floor, np.partition(screen, f.shape[0] - k, axis=1)[:, f.shape[0] - k])
            r, c = np.nonzero(screen >= (floor - SLACK * length[rows] * top)[:, None])
            u, v = users[rows[r]], f[c]
            score = np.zeros(len(r))
            for d in range(f.shape[1]):  # in one order for every pair
                score += u[:, d] * v[:, d]
            good = score > min_score
            lists.merge(rows[r[good]], score[good], ids[c[good]])
    return left, products


def _search_wave(shared, k: int, min_score: float, after: float):
    """``after``: largest norm of the blocks that follow (0: none do)."""
    def run(batches):
        blocks = [(top, np.frombuffer(ids, np.int64), np.frombuffer(f).reshape(len(ids) // 8, -1))
                  for top, ids, f in shared.value]
        for whole in batches:
            for lo in range(0, whole.num_rows, 4 * LEFT_ROWS):
                b = whole.slice(lo, 4 * LEFT_ROWS)
                n = b.num_rows
                users, lists = _matrix(b.column(1), n), Lists.of(n, k)
                had = np.asarray(b.column(2).value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
                lists.merge(np.repeat(np.arange(n), had), b.column(3).flatten().to_numpy(zero_copy_only=False),
                            b.column(2).flatten().to_numpy(zero_copy_only=False))
                search(users, blocks, lists, min_score)
                reach = np.sqrt((users * users).sum(axis=1)) * after * (1 + SLACK)
                is_open = (reach > min_score) & (reach >= lists.scores[:, k - 1])
                taken = lists.scores > -np.inf
                ends = pa.array(np.concatenate([[0], np.cumsum(taken.sum(axis=1))]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.ListArray.from_arrays(ends, pa.array(lists.ids[taken])),
                     pa.ListArray.from_arrays(ends, pa.array(lists.scores[taken])), pa.array(is_open)],
                    names=["a", "f", "ids", "scores", "open"])
    return run


def _waves(blocks: DataFrame, wave_bytes: int) -> list[list]:
    """Places, sizes and norms of the blocks, in runs of at most ``wave_bytes``."""
    rows = blocks.select("part", "seq", "top", (F.octet_length("ids") + F.octet_length("f")).alias("size")).collect()
    waves, room = [], 0
    for r in sorted(rows, key=lambda r: (r["part"], r["seq"])):
        if not waves or r["size"] > room:
            waves.append([])
            room = wave_bytes
        waves[-1].append(r)
        room -= r["size"]
    return waves


def norm_top_k(left: DataFrame, right: DataFrame, k: int, min_score: float = 0.0,
               block: int = BLOCK, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """For every left row (id INT, f ARRAY) its k best right rows by inner
    product above ``min_score``: (a, rank, b, score), ties to the smaller b."""
    spark = left.sparkSession
    blocks = _written(norm_blocks(right, block), "norm-blocks")
    waves = _waves(blocks, wave_bytes)
    state = _vectors(left).select(
        F.col("id").alias("a"), "f", F.array().cast("array<bigint>").alias("ids"),
        F.array().cast("array<double>").alias("scores"))
    lists = state.select("a", "ids", "scores").limit(0)
    for i, wave in enumerate(waves):
        first, last = wave[0], wave[-1]
        place = F.struct("part", "seq")
        rows = blocks.where(F.col("part").between(first["part"], last["part"])).where(
            place.between(*[F.struct(F.lit(r["part"]).alias("part"), F.lit(r["seq"]).alias("seq"))
                            for r in (first, last)])).collect()
        rows.sort(key=lambda r: (r["part"], r["seq"]))
        shared = spark.sparkContext.broadcast([(r["top"], bytes(r["ids"]), bytes(r["f"])) for r in rows])
        after = waves[i + 1][0]["top"] if i + 1 < len(waves) else 0.0
        out = state.mapInArrow(_search_wave(shared, k, float(min_score), after), _STATE)
        if i + 1 == len(waves):
            lists = out if i == 0 else lists.unionByName(out.select("a", "ids", "scores"))
            break
        out = _written(out, "norm-lists")
        shared.destroy()
        closed = out.where("not open").select("a", "ids", "scores")
        lists = closed if i == 0 else lists.unionByName(closed)
        state = out.where("open").select("a", "f", "ids", "scores")
        if state.isEmpty():
            break
    return (lists.select("a", F.posexplode(F.arrays_zip("ids", "scores")).alias("place", "best"))
            .select("a", (F.col("place") + 1).alias("rank"), F.col("best.ids").cast("int").alias("b"),
                    F.col("best.scores").alias("score")))
