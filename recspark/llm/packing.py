"""Packing documents into windows by non-negative least squares.

1. Each document is tokenised (with an end id) and cut into whole windows, one
   main piece of a multiple of ``UNIT`` ids and a tail shorter than ``UNIT``.
   Pieces thus have few lengths (63 main ones and 31 tails at 2048 / 32), and
   one aggregation gives their histogram over all documents.
2. Shallow combinations of main lengths that fill a window exactly are
   enumerated: up to three lengths, or one length repeated plus its
   complement.  Non-negative least squares (Lawson-Hanson) finds how often to
   use each so that the histogram is met; the counts are rounded down,
   checked against what is there, and topped up greedily.
3. A piece's rank among all pieces of its length (its place in its task plus
   the counts of the tasks before) decides its combination, sequence and
   offset by arithmetic, so nothing is sorted or gathered.
4. What no combination takes (residuals and tails) is packed greedily: laid
   end to end, length by length, and cut at window borders.  The last, partly
   filled window is split into powers of two, which need no padding.

Tasks read and write bounded batches; the driver sees the histogram only.

Edge cases: a null or empty text is its end id alone; a null or repeated
doc_id is carried along; an empty table gives no pieces; texts of any length
are cut as above; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recspark.llm.common import small_batches, texts, written
from recspark.llm.tokens import KIND, encoder

WINDOW = 2048
UNIT = 32
END = 1
PIECES = "doc_id long, start long, length int, ids binary, doc_tokens long, part int, rank long"
PACKED = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _cut(path: str | None, window: int, unit: int, end: int):
    def run(batches):
        part, seen = TaskContext.get().partitionId(), {}
        closing = np.array([end], dtype="<u4").tobytes()
        for b in small_batches(batches, limit=1 << 20, held=KIND):
            ids_of = encoder(path).encode(texts(b))
            n = np.fromiter(map(len, ids_of), np.int64, len(ids_of)) // 4 + 1
            # whole windows, then (for what is left) whole units, then the tail
            whole, left = np.divmod(n, window)
            main = left // unit * unit
            pieces = whole + (main > 0) + (left > main)
            row = np.repeat(np.arange(len(n)), pieces)
            k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            is_main = (k == whole[row]) & (main[row] > 0)
            size = np.where(k < whole[row], window, np.where(is_main, main[row], (left - main)[row]))
            start = np.where(k <= whole[row], k * window, whole[row] * window + main[row])
            rank = np.empty(len(row), np.int64)
            for s in np.unique(size).tolist():
                at = np.flatnonzero(size == s)
                rank[at] = seen.get(s, 0) + np.arange(len(at))
                seen[s] = seen.get(s, 0) + len(at)
            # the pieces lie in order, so their ids are one buffer with offsets
            edges = np.concatenate([[0], np.cumsum(4 * size)])
            ids = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(row),
                [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(closing.join([*ids_of, b""]))])
            doc = b.column(0).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(start), pa.array(size, pa.int32()), ids.cast(pa.binary()), pa.array(n[row]),
                 pa.array(np.full(len(row), part), pa.int32()), pa.array(rank)],
                names=[c.split()[0] for c in PIECES.split(", ")])
    return run


def pieces(docs: DataFrame, path: str | None = None, window: int = WINDOW, unit: int = UNIT,
           end: int = END) -> DataFrame:
    """The pieces of every document; ``rank`` counts a task's pieces of one length."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_cut(path, window, unit, end), PIECES)


def combinations(units: int) -> list[dict[int, int]]:
    """Ways to fill ``units`` with up to three lengths, or with one length as
    often as it fits and its complement: {length: times}."""
    found = set()
    for a in range(1, units):
        for b in range(1, a + 1):
            if a + b <= units:
                c = units - a - b
                if c <= b:
                    found.add(tuple(sorted([a, b] + [c] * (c > 0))))
        n, rest = divmod(units, a)
        found.add(tuple(sorted([a] * n + [rest] * (rest > 0))))
    return [{x: combo.count(x) for x in combo} for combo in sorted(found)]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """argmin |a x - b| over x >= 0 (Lawson-Hanson active set)."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds):
        w = np.where(used, -np.inf, a.T @ (b - a @ x))
        j = int(np.argmax(w))
        if used.all() or w[j] <= tolerance:
            break
        used[j] = True
        while True:
            s = np.zeros_like(x)
            s[used] = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            low = used & (s <= 0)
            if not low.any():
                break
            step = (x[low] / np.maximum(x[low] - s[low], 1e-300)).min()
            x = x + step * (s - x)
            used &= x > 1e-12
            x[~used] = 0
            if not used.any():
                break
        x = s
    return x


class Layout:
    """Sequence and offset of every piece, from the histogram of lengths."""

    def __init__(self, count: dict[int, int], window: int = WINDOW, unit: int = UNIT):
        units = window // unit
        left = {q: count.get(q * unit, 0) for q in range(1, units)}
        combos = combinations(units)
        a = np.array([[c.get(q, 0) for c in combos] for q in range(1, units)], dtype=float).reshape(units - 1, -1)
        b = np.array([left[q] for q in range(1, units)], dtype=float)
        wanted = np.floor(nnls(a, b) + 1e-6).astype(np.int64) if b.any() else np.zeros(len(combos), np.int64)
        uses = np.zeros(len(combos), np.int64)
        for goal in (wanted, None):  # the solution first, then whatever still fits
            for j in sorted(range(len(combos)), key=lambda j: (-wanted[j], j)):
                n = min(left[q] // m for q, m in combos[j].items())
                n = n if goal is None else min(n, int(goal[j]))
                uses[j] += n
                for q, m in combos[j].items():
                    left[q] -= n * m
        self.window = window
        self.slots: dict[int, list[tuple[int, int, int, int]]] = {}  # length -> (first rank, per sequence, sequence, offset)
        self.taken: dict[int, int] = {}
        sequence = count.get(window, 0)  # whole windows have the first sequences
        for j, c in enumerate(combos):
            if not uses[j]:
                continue
            at = 0
            for q, m in c.items():
                size = q * unit
                first = self.taken.get(size, 0)
                self.slots.setdefault(size, []).append((first, m, sequence, at))
                self.taken[size] = first + m * int(uses[j])
                at += m * size
            sequence += int(uses[j])
        self.first_rest, total = sequence, 0
        self.base: dict[int, int] = {}  # where a length's residuals start in the residual stream
        for size in sorted(count, reverse=True):
            if size != window:
                self.base[size] = total
                total += size * (count[size] - self.taken.get(size, 0))
        borders = [total // window * window]
        for bit in reversed(range(window.bit_length())):
            if (total % window) >> bit & 1:
                borders.append(borders[-1] + (1 << bit))
        self.borders = borders

    def place(self, size: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(from, length, sequence, offset) of each part of a piece."""
        if size == self.window:
            return [(0, size, rank, 0)]
        if rank < self.taken.get(size, 0):
            first, m, sequence, at = next(s for s in reversed(self.slots[size]) if s[0] <= rank)
            i = rank - first
            return [(0, size, sequence + i // m, at + i % m * size)]
        pos, out, done = self.base[size] + (rank - self.taken.get(size, 0)) * size, [], 0
        while done < size:
            if pos < self.borders[0]:
                k, offset = divmod(pos, self.window)
                room = self.window - offset
            else:
                j = next(j for j in range(1, len(self.borders)) if pos < self.borders[j])
                k, offset = self.borders[0] // self.window + j - 1, pos - self.borders[j - 1]
                room = self.borders[j] - pos
            n = min(room, size - done)
            out.append((done, n, self.first_rest + k, offset))
            done, pos = done + n, pos + n
        return out


def _assign(layout: Layout):
    def run(batches):
        for b in batches:
            rows = []
            for doc, start, size, ids, n, rank in zip(*(c.to_pylist() for c in b.columns)):
                for at, length, sequence, offset in layout.place(size, rank):
                    rows.append((doc, start + at, length, ids[4 * at:4 * (at + length)], n, sequence, offset))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
                    names=[c.split()[0] for c in PACKED.split(", ")])
    return run


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, unit: int = UNIT,
         end: int = END) -> DataFrame:
    """Every piece of every document with its ids, sequence and offset."""
    cut = written(pieces(docs, path, window, unit, end), "pieces")
    by_task = written(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    count = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    first = written(by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")),
                    "piece-ranks")
    return (cut.join(first, ["part", "length"])
            .select("doc_id", "start", "length", "ids", "doc_tokens", (F.col("rank") + F.col("first")).alias("rank"))
            .mapInArrow(_assign(Layout(count, window, unit)), PACKED))
