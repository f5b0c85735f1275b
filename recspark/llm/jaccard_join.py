"""Exact Jaccard join of documents on word shingles, by metric-space regions.

The Jaccard distance d(x, y) = 1 - |x n y| / |x u y| is a metric; documents
with d <= 0.2 are linked.

1. Classes.  Documents with equal shingle sets are one class (64-bit hash of
   the sorted set of 64-bit shingle hashes); only classes are compared.
2. Pivots and Voronoi regions.  The pivots are the one-shingle sets {s}:
   d(x, {s}) = 1 - 1 / |x| for each s in x and 1 for any other, so a class's
   nearest pivots are its shingles, all at the same distance; the tie is
   broken by one global order, rare shingles first.
3. Windows.  Two linked classes differ in at most a fifth of the larger set,
   so by the triangle inequality a class that has lost its first regions to
   the difference must still meet its partner in one of its first
   ``|x| - ceil(0.8 |x|) + 1`` regions: it is replicated to these.  Sizes
   outside 0.8 .. 1.25 and positions that leave too little overlap are out.
4. Recursion.  A region of at most ``SMALL`` classes compares them all.  A
   larger one takes a document as pivot p and measures d(x, p) for all its
   classes: those within 0.2 are linked to p and thus in one component.  If
   more than one component is left, the region is joined again without p, by
   a next pivot, with pairs of one component left out (they can't change the
   result).  After ``ROUNDS`` pivots what is left is joined on the region,
   without pairs with |d(x, p) - d(y, p)| > 0.2 for one of its pivots p, which
   the triangle inequality rules out, and without pairs whose folded sketches
   differ too much (see 5); a pair that meets in many regions is taken in the
   first.  Every link between different components is
   therefore found.
5. A candidate pair is dropped if its parity sketches differ in more bits
   than the symmetric difference of linked sets can have (a lower bound of it,
   so no link is lost); the others are verified exactly on their texts, and
   links go to a distributed union-find.

The order of rarity uses the number of classes that meet in the first regions
under plain hash order, over all documents, kept as levels in ``LEVELS``
buckets; any order gives the same result.

Edge cases: null or word-less texts have no set, link with nothing and are
their own component; texts shorter than a shingle have their whole sequence
as only shingle; repeated rows fall into one class; a null doc_id takes part
and shows its component's smallest doc_id that is not null; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recspark.llm.common import cut, maybe, mix64, numbered, small_batches, texts, written
from recspark.llm.components import components

WORDS = 5
PERCENT = 80
SMALL = 8
ROUNDS = 1
CROWD, SPREAD = 64, 6  # classes in a region from which on its group of copies draws so many pivots a round
LEVELS = 1 << 20
HOT = 8             # classes in a region from which on its shingle counts as frequent
SAMPLED = 4         # of a class's first regions, the share (1 in ..) that the rarity count looks at
FILTER = 24         # log2 of the least bits of the filter of documents whose texts are compared
HEADS = 8           # regions by which a pair's first common one is known
BITS = 2048         # of a parity sketch, at least
FOLD = 8            # 64-bit words of its folded form
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
               0xA0761D6478BD642F], dtype=np.uint64)


def shingle_sets(batch: pa.RecordBatch, k: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a batch."""
    words = [t.encode("utf-8", "replace").lower().split() for t in texts(batch)]
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter((digest(w) for ws in words for w in ws), dtype=np.uint64, count=int(n.sum()))
    rolled = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k):
        rolled += h[j:len(h) - k + 1 + j] * _K[j % len(_K)]
    rolled = mix64(rolled)
    out, at = [], 0
    for m in n.tolist():
        if m >= k:
            out.append(np.unique(rolled[at:at + m - k + 1]))
        elif m:
            out.append(np.array([digest(h[at:at + m].tobytes(), seed=m)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at += m
    return out


def _class(s: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None


def _sketch(s: np.ndarray) -> np.ndarray:
    """For each of BITS buckets, whether an odd number of shingles fall into
    it; for a larger set, as many times twice the buckets as it takes to have one
    a shingle.  The bits in which two sketches differ number at most |x ^ y|, and
    the two halves of one, taken bit by bit for parity, are the one of half the size."""
    bits = max(BITS, 1 << (len(s) - 1).bit_length())
    place = (s >> np.uint64(53)) | ((s >> np.uint64(20)) & np.uint64(bits // BITS - 1)) << np.uint64(11)
    odd = np.bincount(place.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _classes(batches):
    """Class and set size of every document in place of its text (the last column)."""
    for b in small_batches(batches):
        sets = shingle_sets(b)
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:-1], pa.array([_class(s) for s in sets], pa.int64()),
             pa.array([len(s) for s in sets], pa.int64()), pa.array([_sketch(s) for s in sets], pa.list_(pa.int64()))],
            names=[*b.schema.names[:-1], "cid", "n", "sketch"])


def _prefixes(levels, counts_only: bool):
    """(shingle, class, size, position) for the regions a class goes to."""
    def run(batches):
        level = None if levels is None else levels.value
        for b in small_batches(batches):
            s_all, c_all, n_all, p_all = [], [], [], []
            for s in shingle_sets(b):
                n = len(s)
                if not n:
                    continue
                p = n - (PERCENT * n + 99) // 100 + 1
                if level is not None:
                    rank = level[(s >> np.uint64(44)).astype(np.int64)]
                    if rank.any():
                        s = s[np.argsort(rank, kind="stable")]
                if counts_only:
                    p = -(-p // SAMPLED)
                s_all.append(s[:p].view(np.int64))
                if not counts_only:
                    c_all.append(np.full(p, _class(np.sort(s)), np.int64))
                    n_all.append(np.full(p, n, np.int32))
                    p_all.append(np.arange(p, dtype=np.int32))
            if s_all:
                cols = [s_all] if counts_only else [s_all, c_all, n_all, p_all]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols],
                                                 names=["s", "cid", "n", "pos"][:len(cols)])
    return run


def _distinct_sets(b: pa.RecordBatch, column: str) -> list[np.ndarray]:
    """Shingle sets of a column's texts; a pivot's text, in many pairs, is cut once."""
    coded = b.column(b.schema.get_field_index(column)).dictionary_encode()
    sets = shingle_sets(pa.RecordBatch.from_arrays([coded.dictionary], names=["text"]))
    return [sets[i] for i in coded.indices.to_pylist()]


def _verify(batches):
    """Sizes of intersection and union of the shingle sets of two texts."""
    for b in small_batches(small_batches(batches, "ta", 4 << 20), "tb", 4 << 20):
        x, y = (_distinct_sets(b, c) for c in ("ta", "tb"))
        inter = [len(np.intersect1d(i, j, assume_unique=True)) for i, j in zip(x, y)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(inter, pa.int64()),
             pa.array([len(i) + len(j) - n for i, j, n in zip(x, y, inter)], pa.int64())], names=["a", "b", "inter", "uni"])


def _levels(docs: DataFrame):
    """Broadcast rarity level of each bucket of shingles (at most LEVELS
    bytes), or None if no region is hot."""
    n = docs.mapInArrow(_prefixes(None, True), "s long").groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") >= HOT)
    rows = n.groupBy(F.expr("cast(shiftrightunsigned(s, 44) as int)").alias("b")).agg(
        F.max(F.floor(F.log2("n"))).cast("int").alias("l")).toPandas()
    if not len(rows):
        return None
    level = np.zeros(LEVELS, np.uint8)
    level[rows["b"].to_numpy()] = rows["l"].to_numpy()
    return docs.sparkSession.sparkContext.broadcast(level)


def _fits(a: str, b: str):
    """Size and position windows of a candidate pair."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    overlap = 1 + F.least(na - F.col(f"{a}.pos"), nb - F.col(f"{b}.pos")) - 1
    return ((100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb))
            & ((100 + PERCENT) * overlap >= PERCENT * (na + nb)))


def _pair(a: str, b: str) -> list:
    x, y = F.col(f"{a}.cid"), F.col(f"{b}.cid")
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _folded() -> list:
    """A member's sketch folded to FOLD words (parities of parities)."""
    word = lambda j: F.aggregate(F.sequence(F.lit(j), F.size("sketch") - 1, F.lit(FOLD)), F.lit(0).cast("long"),
                                 lambda t, i: t.bitwiseXOR(F.get("sketch", i)))
    return [word(j).alias(f"f{j}") for j in range(FOLD)]


def _differ(x: str, y: str):
    """The bits in which two sketches differ; linked sets' sketches are as long
    or one is twice as long, which is folded then."""
    def other(a, b):
        half = (F.size(a) / 2).cast("int")
        return F.when(F.size(a) > F.size(b), F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half),
                                                        lambda u, v: u.bitwiseXOR(v))).otherwise(F.col(a))
    return F.aggregate(F.zip_with(other(x, y), other(y, x), lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda t, n: t + n)


def _near(a: str, b: str):
    """The folded sketches differ in no more bits than linked sets can."""
    bits = sum((F.bit_count(F.col(f"{a}.f{j}").bitwiseXOR(F.col(f"{b}.f{j}"))) for j in range(FOLD)), F.lit(0))
    return (100 + PERCENT) * bits <= (100 - PERCENT) * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _heads(large: DataFrame) -> DataFrame:
    """Each class's first ``HEADS`` regions of those left.  If two classes share
    one of these, their first common region is among them: the pair is taken
    there, where its windows are tightest, and needn't be taken again."""
    first = F.slice(F.array_sort(F.collect_list(F.struct("pos", "s"))), 1, HEADS)
    return large.groupBy("cid").agg(F.transform(first, lambda p: p["s"]).alias("heads"))


def _measure(docs: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, inter, uni) of the candidate pairs whose sketches differ in no
    more bits than linked sets can; exact, on whole texts, which are read again
    for these pairs alone."""
    side = lambda c: members.select(F.col("cid").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    near = (pairs.join(side("a"), "a").join(side("b"), "b")
            .where((100 + PERCENT) * _differ("sa", "sb") <= (100 - PERCENT) * (F.col("na") + F.col("nb"))).select("a", "b"))
    near = cut(near)
    wanted = near.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    wanted = cut(members.select("cid", "k", "th").join(wanted, "cid", "left_semi"))
    needed = written(_maybe(docs.withColumn("k", _key()), wanted).join(wanted, ["k", "th"]).dropDuplicates(["k", "th"])
                     .select("cid", "text"), "candidates")
    text = lambda c: needed.select(F.col("cid").alias(c), F.col("text").alias(f"t{c}"))
    return (near.join(text("b"), "b").join(text("a"), "a").select("a", "b", "ta", "tb")
            .mapInArrow(_verify, "a long, b long, inter long, uni long"))


def _maybe(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Without most of the documents that are not ``wanted``, so that their
    texts needn't be shuffled."""
    return maybe(docs, wanted, "k", "th", least=FILTER)


def _key():
    return F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))


def linked() -> F.Column:
    return F.col("inter") * 100 >= F.col("uni") * PERCENT


def jaccard_components(documents: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, n_shingles, cid (class), group (of classes), component_id and
    the column named by ``row`` for every row."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"),
                           (F.col(row) if row else F.lit(0)).cast("long").alias("row"), "text")
    classes = cut(own.mapInArrow(_classes, "doc_id long, th long, row long, cid long, n long, sketch array<long>"))
    reps = classes.where("cid is not null").groupBy("cid").agg(
        F.min(F.struct(_key().alias("k"), "th")).alias("r"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    by_shingle = W.partitionBy("s")
    regions = written(
        docs.mapInArrow(_prefixes(_levels(docs), False), "s long, cid long, n int, pos int")
        .repartition("s").groupBy("s", "cid").agg(F.first("n").alias("n"), F.min("pos").alias("pos"))
        .withColumn("size", F.count("*").over(by_shingle)).where("size > 1"), "regions")

    # one document of each class that meets another, and the sketch
    members = written(reps.join(regions.select("cid").distinct(), "cid", "left_semi")
                      .select("cid", "r.k", "r.th", "n", "sketch"), "members")
    small, large = regions.where(F.col("size") <= SMALL), regions.where(F.col("size") > SMALL)
    pairs = (small.alias("x").join(small.alias("y"), "s").where("x.cid < y.cid").where(_fits("x", "y"))
             .select(*_pair("x", "y")))
    links, roots = None, None
    seen = None  # (s, pivot) of the rounds so far, with the measured distances
    for turn in range(ROUNDS + 1):
        if turn:
            # distance to the region's last pivot, where it was measured
            ends = (F.least("cid", "pcid") == F.col("a")) & (F.greatest("cid", "pcid") == F.col("b"))
            near = (large.drop("root").join(pivots.select("ps", "pcid"), F.col("s") == F.col("ps")).where("cid <> pcid")
                    .join(measured.select("a", "b", (1 - F.col("inter") / F.col("uni")).alias(f"d{turn}")), ends, "left")
                    .drop("a", "b", "ps", "pcid"))
            own = (near.join(roots.withColumnRenamed("id", "cid"), "cid", "left")
                   .withColumn("root", F.coalesce("root", "cid")))
            large = written(own.withColumn("lo", F.min("root").over(by_shingle))
                            .withColumn("hi", F.max("root").over(by_shingle))
                            .where("lo <> hi").drop("lo", "hi"), "regions-left")
            if large.isEmpty():
                break
            pairs = None
        if turn < ROUNDS:
            # a crowded group of copies draws several pivots in one round
            drawn = F.when(F.col("size") > CROWD, F.pmod("s", F.lit(SPREAD))).otherwise(0)
            order = F.struct(F.xxhash64("cid", F.lit(turn), drawn), "cid", "n", "pos")
            pivots = large.groupBy(F.col("s").alias("ps")).agg(F.min(order).alias("p")).select(
                "ps", F.col("p.cid").alias("pcid"), F.struct(F.col("p.cid").alias("cid"), F.col("p.n").alias("n"), F.col("p.pos").alias("pos")).alias("p"))
            pivots = cut(pivots)
            star = (large.alias("x").join(pivots, F.col("x.s") == F.col("ps")).where("x.cid <> pcid")
                    .where(_fits("x", "p")).select(*_pair("x", "p")))
            pairs = star if pairs is None else pairs.union(star)
        else:
            folded = large.join(members.select("cid", *_folded()), "cid").join(_heads(large), "cid")
            x, y = folded.alias("x"), folded.alias("y")
            # a pair meets in many regions: it is taken in the first one, where that is known
            both = F.array_intersect("x.heads", "y.heads")
            once = (F.size(both) == 0) | (F.get(both, 0) == F.col("x.s"))
            window = F.lit(True)
            for t in range(1, turn + 1):
                gap = F.abs(F.col(f"x.d{t}") - F.col(f"y.d{t}"))
                window &= F.coalesce(gap <= 1 - PERCENT / 100 + 1e-9, F.lit(True))
            pairs = (x.join(y, "s").where("x.cid < y.cid and x.root <> y.root").where(_fits("x", "y") & window & _near("x", "y") & once)
                     .select(*_pair("x", "y")))
        pairs = pairs.distinct()
        if seen is not None:
            pairs = pairs.join(seen.select("a", "b"), ["a", "b"], "left_anti")
        measured = cut(_measure(docs, members, cut(pairs)))
        seen = measured if seen is None else seen.union(measured)
        found = measured.where(linked()).select("a", "b")
        links = found if links is None else links.union(found)
        roots = cut(components(links))
    first = classes.where("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("d"))
    grouped = first.join(roots.withColumnRenamed("id", "cid"), "cid", "left").withColumn("g", F.coalesce("root", "cid"))
    least = grouped.groupBy("g").agg(F.min("d").alias("component_id"))
    named = grouped.join(least, "g").select("cid", "g", "component_id")
    return classes.join(named, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "cid", F.col("g").alias("group"),
        F.when(F.col("g").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        *([F.col("row").alias(row)] if row else []))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each group of linked rows the first by doc_id (null last), then by
    its place in the table; rows without words all stay."""
    rows, row = numbered(docs)
    found = jaccard_components(rows.select("doc_id", "text", F.col(row).alias("place")), "place")
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "place")
    kept = (found.where("group is not null").groupBy("group").agg(F.min(first).alias("f")).select("f.place")
            .union(found.where("group is null").select("place")))
    return rows.join(kept.withColumnRenamed("place", row), row, "left_semi").select(*docs.columns)
