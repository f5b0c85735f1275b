"""Fuzzy line deduplication, one line kept per group of near-equal lines.

1. Texts are split at line feeds.  A line with a word takes part; blank lines
   stay where they are.
2. A line's shingles are its ``CHARS``-character windows, one at every
   character; a shorter line is one shingle.  All windows of a batch are hashed
   together by doubling (1, 2, 4, 8, 12 characters).
3. Signatures: ``BANDS`` x ``ROWS`` minima of the windows' hashes under different
   affine orders; a band's key is the hash of its minima.  At similarity 0.8 a
   pair shares a band with probability 1 - (1 - 0.8 ** 4) ** 9 = 0.991 (the test
   measures it); four rows keep lines that merely share a passage apart.
4. Links to a head: every line of a band bucket is compared with one line of it,
   drawn by hash, so the bands of a group draw different heads; a distributed
   union-find joins what is linked.  Buckets that still hold several groups do
   this ``ROUNDS`` times with new heads.
5. All other pairs: lines of a bucket that holds several groups even then are
   compared with each other, if their groups differ, their sizes allow the
   similarity, and their parity sketches differ in no more bits than near-equal
   sets can (a lower bound of the difference, so no link is lost); a crowded
   bucket is dealt over salts.  Nothing is capped: a pair that shares a bucket is compared or is
   already in one group.  Exact Jaccard similarity of the shingle sets decides
   in both steps, and equal lines are one line from the start.
6. Of each group the first occurrence in (doc_id, row, position) order stays,
   every other occurrence is taken out of its text.

Signatures and comparisons run in numpy on Arrow batches: in DataFrame functions
alone the windows and the sets of each pair cost several times the budget (the
README has the figures).  Lines and windows are known by 64-bit hashes.

Edge cases: null texts stay null; empty texts and texts without words stay as
they are; a document that had words and has no line left is dropped by
``dedup_lines`` (``kept_lines`` 0 in ``line_groups``); a null doc_id comes
after all others; repeated rows are ordered by their place in the table, so
one of them stays; very long lines are handled like any others; other columns
are carried along, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recspark.llm.common import cut, fresh, maybe, mix64, numbered, small_batches, texts, written
from recspark.llm.components import components

CHARS = 12
BANDS = 9
ROWS = 4
ROUNDS = 1
PERCENT = 80
SALT = 256           # lines of a bucket that one salt takes
SKETCH = 512         # bits of a line's parity sketch
BATCH = 1 << 17      # bytes of text whose windows are hashed together: what a core's cache holds
SEEN = 1 << 19       # lines that a task remembers having signed
_HAS_WORD = r"[^\x20\x09-\x0D]"
_BLANKS = " \t\n\x0b\x0c\r"
_P = np.uint64(0x9E3779B97F4A7C15)
# affine orders of 32-bit hashes: odd factors and shifts
_ORDERS = mix64(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * _P).astype(np.uint32).reshape(2, -1)


def line_key(line: bytes) -> int:
    """A line's key, as Spark's xxhash64 gives it."""
    key = xxhash.xxh64_intdigest(line, seed=42)
    return key - (1 << 64) if key >> 63 else key


def window_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the windows of all lines, and where each line's begin;
    a line shorter than a window has one, of the whole of it."""
    size = np.array([len(x) for x in lines], np.int64)
    code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    code = np.concatenate([code, np.zeros(CHARS, np.uint64)])
    spans, width, power = {1: code}, 1, _P
    while 2 * width <= CHARS:
        before = spans[width]
        spans[2 * width] = before[:-width] + before[width:] * power
        power, width = power * power, 2 * width
    whole, left = spans[width], CHARS - width  # 8 and 4 characters more
    whole = whole[:-left] + spans[left][width:][:len(whole) - left] * power if left else whole
    at = np.cumsum(size) - size
    n = np.maximum(size - CHARS + 1, 1)
    begin = np.cumsum(n) - n
    out = whole[np.repeat(at - begin, n) + np.arange(n.sum())]
    short = np.flatnonzero(size < CHARS)
    out[begin[short]] = [xxhash.xxh64_intdigest(lines[i].encode("utf-8", "surrogatepass"), seed=1) for i in short]
    return mix64(out), begin


def window_sets(lines: list[str]) -> list[np.ndarray]:
    """Each line's distinct window hashes, sorted."""
    hashes, begin = window_hashes(lines)
    for own in np.split(hashes, begin[1:]):
        own.sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[begin] = True
    return np.split(hashes[new], np.cumsum(np.add.reduceat(new, begin, dtype=np.int64))[:-1])


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sets."""
    both = np.concatenate([x, y])
    both.sort()
    return np.count_nonzero(both[1:] == both[:-1])


def bands(lines: list[str]) -> np.ndarray:
    """The keys of each line's bands."""
    hashes, begin = window_hashes(lines)
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(lines), BANDS), np.int64)
    for band in range(BANDS):
        key = np.full(len(lines), band + 1, np.uint64)
        for i in range(band * ROWS, (band + 1) * ROWS):
            least = np.minimum.reduceat(low * (_ORDERS[0, i] | np.uint32(1)) + _ORDERS[1, i], begin)
            key = mix64((key ^ least) * _P)
        out[:, band] = key.view(np.int64)
    return out


def _sign(batches):
    """(key, band) of the lines with a word; a line that the task has signed
    is left out, as long as it is remembered."""
    seen: set[int] = set()
    for b in small_batches(batches, limit=BATCH):
        new = {}
        for text in texts(b):
            for line in text.split("\n"):
                if line.strip(_BLANKS):
                    key = line_key(line.encode("utf-8", "surrogatepass"))
                    if key not in seen:
                        new[key] = line
        if len(seen) + len(new) > SEEN:
            seen.clear()
        seen.update(new)
        if new:
            found = bands(list(new.values()))
            keys = np.fromiter(new, np.int64, len(new))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys, BANDS)), pa.array(found.ravel())], names=["key", "band"])


def signatures(rows: DataFrame) -> DataFrame:
    """(key, band) for every line of the texts; lines may occur repeatedly."""
    return rows.select("text").mapInArrow(_sign, "key long, band long")


def _compare(batches):
    """The pairs whose lines are near-equal."""
    for b in small_batches(small_batches(batches, "la", BATCH), "lb", BATCH):
        sides = []
        for c in ("la", "lb"):
            coded = b.column(b.schema.get_field_index(c)).dictionary_encode()  # a head is in many pairs
            sets = window_sets(coded.dictionary.to_pylist())
            sides.append([sets[i] for i in coded.indices.to_pylist()])
        near = [(100 + PERCENT) * _shared(x, y) >= PERCENT * (len(x) + len(y))
                for x, y in zip(*sides)]
        yield b.select(["a", "b"]).filter(pa.array(near))


def _links(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs (a, b) whose lines are near-equal."""
    both = (pairs.join(lines.select(F.col("key").alias("b"), F.col("line").alias("lb")), "b")
            .join(lines.select(F.col("key").alias("a"), F.col("line").alias("la")), "a"))
    return both.select("a", "b", "la", "lb").mapInArrow(_compare, "a long, b long")


def _sketch(batches):
    """Set size and, for each of ``SKETCH`` buckets, whether an odd number of
    shingles falls into it; sketches differ in at most |x ^ y| bits."""
    for b in small_batches(batches, "line", BATCH):
        sets = window_sets(texts(b, "line"))
        odd = [np.bincount((x >> np.uint64(55)).astype(np.int64), minlength=SKETCH) & 1 for x in sets]
        words = np.packbits(np.array(odd, np.uint8), axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in sets], pa.int64()), *map(pa.array, words.T)],
                                         names=["key", "n", *(f"f{j}" for j in range(SKETCH // 64))])


def _rest_pairs(crowd: DataFrame, lines: DataFrame) -> DataFrame:
    """(a, b) of different groups that share a bucket and may be near-equal, for
    (band, key, root)."""
    own = lines.join(crowd.select("key").distinct(), "key", "left_semi").select("key", "line")
    sketch = [f"f{j}" for j in range(SKETCH // 64)]
    sketched = cut(own.mapInArrow(_sketch, ", ".join(f"{c} long" for c in ["key", "n", *sketch])))
    crowd = crowd.join(sketched, "key")
    bits = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in sketch), F.lit(0))
    fits = ((100 * F.least("x.n", "y.n") >= PERCENT * F.greatest("x.n", "y.n"))
            & ((100 + PERCENT) * bits <= (100 - PERCENT) * (F.col("x.n") + F.col("y.n"))))
    salts = crowd.groupBy("band").agg(F.ceil(F.count("*") / SALT).cast("int").alias("salts"))
    met = crowd.join(salts, "band")
    left = met.select("*", F.pmod(F.hash("key"), F.col("salts")).alias("salt")).alias("x")
    right = met.select("*", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")).alias("y")
    return (left.join(right, ["band", "salt"]).where("x.root < y.root").where(fits)
            .select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct())


def _star(crowd: DataFrame, turn: int) -> DataFrame:
    """(a, b): the lines of each bucket with its head of this round, for (band,
    key, root); lines that are in the head's group already are left out."""
    head = F.min_by(F.struct("key", "root"), F.xxhash64("key", "band", F.lit(turn))).over(W.partitionBy("band"))
    return (crowd.withColumn("head", head).where("root <> head.root")
            .select(F.col("key").alias("a"), F.col("head.key").alias("b")).distinct())


def _several(crowd: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, key, root): the lines of buckets that hold several groups."""
    named = (crowd.select("band", "key").join(roots.withColumnRenamed("id", "key"), "key", "left")
             .withColumn("root", F.coalesce("root", "key")))
    bucket = W.partitionBy("band")
    return written(named.withColumn("lo", F.min("root").over(bucket)).withColumn("hi", F.max("root").over(bucket))
                   .where("lo <> hi").drop("lo", "hi"), "line-crowd")


def _lines(rows: DataFrame, row: str) -> DataFrame:
    """(doc_id, _row, pos, line, key) for every line with a word."""
    return (rows.select("doc_id", F.col(row).alias("_row"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
            .where(F.col("line").rlike(_HAS_WORD)).withColumn("key", F.xxhash64("line")))


def line_groups(rows: DataFrame, row: str = "_row") -> DataFrame:
    """(doc_id, _row, pos, key, group, kept) for every line with a word of
    ``numbered`` rows (``row`` names their place): equal and near-equal lines share a group."""
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row", "pos").alias("place")
    seen = written(_lines(rows, row).select("doc_id", "_row", "pos", "key"), "line-places")
    bucket = W.partitionBy("band")
    crowd = written(signatures(rows).withColumn("lo", F.min("key").over(bucket)).withColumn("hi", F.max("key").over(bucket))
                    .where("lo <> hi").select("band", "key").distinct(), "line-bands")
    wanted = cut(crowd.select("key").distinct())
    lines = written(maybe(_lines(rows, row).select("key", "line"), wanted, "key").join(wanted, "key")
                    .groupBy("key").agg(F.first("line").alias("line")), "line-texts")
    links = roots = None
    for turn in range(1 + ROUNDS):
        found = cut(_links(_star(crowd if turn else crowd.withColumn("root", F.col("key")), turn), lines))
        links = found if links is None else links.union(found)
        roots = cut(components(links))
        crowd = _several(crowd, roots)
        if crowd.isEmpty():
            break
    else:
        roots = cut(components(links.union(cut(_links(written(_rest_pairs(crowd, lines), "line-rest-pairs"), lines)))))
    roots = roots.withColumnRenamed("id", "key")
    firsts = seen.groupBy("key").agg(F.min(place).alias("place"))
    named = firsts.join(roots, "key", "left").withColumn("group", F.coalesce("root", "key"))
    best = named.groupBy("group").agg(F.min("place").alias("best"))
    return (seen.join(named.select("key", "group"), "key").join(best, "group")
            .select("doc_id", "_row", "pos", "key", "group",
                    ((F.col("best._row") == F.col("_row")) & (F.col("best.pos") == F.col("pos"))).alias("kept")))


def deduped(docs: DataFrame) -> DataFrame:
    """Every row with its remaining text, and ``kept_lines`` and
    ``lost_lines`` (which replace input columns of these names)."""
    rows, row = numbered(docs.drop("kept_lines", "lost_lines"))
    own = [c for c in rows.columns if c != row]
    groups = written(line_groups(rows, row), "line-groups")
    gone = fresh("_gone", rows)
    edits = groups.groupBy(F.col("_row").alias(row)).agg(
        F.count_if("kept").alias("kept_lines"), F.count_if(~F.col("kept")).alias("lost_lines"),
        F.collect_set(F.when(~F.col("kept"), F.col("pos"))).alias(gone))
    text = F.when(F.coalesce("lost_lines", F.lit(0)) == 0, F.col("text")).otherwise(F.array_join(F.filter(
        F.split("text", "\n", -1), lambda _, i: ~F.array_contains(gone, i)), "\n"))
    return (rows.join(edits, row, "left").withColumn("text", text)
            .select(*own, F.coalesce("kept_lines", F.lit(0)).alias("kept_lines"),
                    F.coalesce("lost_lines", F.lit(0)).alias("lost_lines")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without repeated lines, and without those of which no
    line is left."""
    kept, lost = fresh("kept_lines", docs), fresh("lost_lines", docs)
    out = deduped(docs.withColumnsRenamed({"kept_lines": kept + "_in", "lost_lines": lost + "_in"}))
    out = out.where("kept_lines > 0 or lost_lines = 0").drop("kept_lines", "lost_lines")
    return out.withColumnsRenamed({kept + "_in": "kept_lines", lost + "_in": "lost_lines"}).select(*docs.columns)
