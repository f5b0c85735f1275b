"""Phrase collocations by FM-indexes over word ids.

Texts become pieces (between ``.,;:!?`` and line breaks) of words; a shard holds
some ``SHARD`` words of one language as ids of its own vocabulary.  Each shard
is indexed by itself (``fmindex``), its phrases are enumerated with their
counts by interval extension, and counts are summed across shards:

1. *Words.*  Sums of the shards' vocabularies give every word's count, and the
   language's total ``n``.  A phrase that occurs ``least`` times has only words
   that do: these get dense global ids, which go back to the shards that hold them.
2. *Pairs.*  Each shard, with all other words as separators, is enumerated to
   depth 2.  A phrase that occurs ``least`` times has only such pairs inside:
   the frequent ones go back to the shards that hold them.
3. *Longer phrases.*  Each shard, cut between words that form no frequent pair,
   is enumerated to the full depth; sums are again exact.

A shard's phrases travel as compressed blocks, one for each bucket of a hash of
their words; there is a bucket for every ``BUCKET`` words of the corpus, so what
a task sums is bounded, and a common word or a large language is no hot key.

A candidate's cuts look up the counts of both parts.  A candidate inside a
longer one that is (to ``cover`` percent) as frequent goes; it is enough to look
at its extensions by one word to the left and right, since what lies between it
and a longer phrase is a candidate as frequent as that one.

Words are bytes of the text with A-Z lower-cased; the pruning in 2 and 3 is by
exact counts and loses nothing.  A task holds one shard: ``SHARD`` words, or
the words of its longest text.  Only ``least`` decides what is found, at any size.

Edge cases: null text is empty, null language is ``und``; texts without words
and languages without candidates give no rows; equal scores rank by count, then
by the phrase's bytes; repeated rows count each time; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recspark.llm.common import mix64, small_batches, texts, written
from recspark.llm.fmindex import SEPARATOR, order_of, phrases

DEPTH = 5
LEAST = 100
TOP = 2000
COVER = 100
SHARD = 1 << 21
BUCKET = 1 << 21
_BREAKS = bytes.maketrans(b",;:!?\x0a\x0b\x0c\x0d", b"." * 9)

_SHARDS = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("tokens", pa.binary()),
                     ("word", pa.string()), ("id", pa.int32()), ("n", pa.int64())])
# a shard's phrases of m words in one bucket, or its text in global ids: local ids from 1, and the global ones in order
_BLOCKS = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("bucket", pa.int64()), ("m", pa.int32()),
                     ("words", pa.binary()), ("n", pa.binary()), ("tokens", pa.binary()), ("known", pa.binary())])
# a frequent word and its number in the partition, or a shard's ids of such words
_NUMBERS = pa.schema([("lang", pa.string()), ("word", pa.string()), ("f", pa.int64()), ("number", pa.int64()),
                      ("shard", pa.int64()), ("ids", pa.binary()), ("numbers", pa.binary())])
# a frequent phrase, or the pairs of a shard that are
_SUMS = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.int64())), ("a", pa.int64()),
                   ("shard", pa.int64()), ("pairs", pa.binary())])


class _Shard:
    """Words of one language, as ids from 1 in order of appearance."""

    def __init__(self, lang: str):
        self.lang, self.size, self.parts = lang, 0, []
        self.ids = _Numbers({b".": SEPARATOR})  # no word holds a break

    def add(self, text: str) -> None:
        # bytes.lower() changes A-Z alone; split() parts at blanks and tabs, the other white space is a break
        tokens = text.encode("utf-8", "surrogatepass").lower().translate(_BREAKS).replace(b".", b" . ").split()
        ids = np.fromiter(map(self.ids.__getitem__, tokens), np.int32, len(tokens))
        self.parts += [ids, _END]
        self.size += len(ids) + 1

    def rows(self, shard: int):
        """Its tokens, and its vocabulary with counts."""
        tokens = np.concatenate(self.parts)
        keep = np.ones(len(tokens), bool)
        keep[1:] = (tokens[1:] != SEPARATOR) | (tokens[:-1] != SEPARATOR)
        tokens = tokens[keep]
        words = [w.decode("utf-8", "replace") for w in self.ids][1:]
        n = np.bincount(tokens, minlength=len(words) + 1)[1:]
        k = len(words)
        yield pa.RecordBatch.from_pydict(
            {"shard": [shard], "lang": [self.lang], "tokens": [_pack(tokens)], "word": [None], "id": [None], "n": [None]},
            schema=_SHARDS)
        for lo in range(0, k, 50_000):
            part = slice(lo, min(lo + 50_000, k))
            m = part.stop - lo
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard] * m, "lang": [self.lang] * m, "tokens": [None] * m, "word": words[part],
                 "id": np.arange(lo + 1, part.stop + 1, dtype=np.int32), "n": n[part]}, schema=_SHARDS)


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


_END = np.array([SEPARATOR], np.int32)


def _cut_shards(limit: int):
    def run(batches):
        number = count(TaskContext.get().partitionId() << 32)
        open_: dict[str, _Shard] = {}
        for batch in small_batches(batches):
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            for lang, text in zip(langs, texts(batch)):
                if lang not in open_:
                    open_[lang] = _Shard(lang)
                open_[lang].add(text)
                if open_[lang].size >= limit:
                    yield from open_.pop(lang).rows(next(number))
            if sum(s.size for s in open_.values()) >= 2 * limit:  # many languages
                for lang in list(open_):
                    yield from open_.pop(lang).rows(next(number))
        for shard in open_.values():
            yield from shard.rows(next(number))
    return run


def _pack(values: np.ndarray) -> bytes:
    """Non-negative integers, compressed: all first bytes, all second ones, ..."""
    values = np.ascontiguousarray(values, dtype="<u4" if int(values.max(initial=0)) < 1 << 32 else "<u8")
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return bytes([values.itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(data: bytes) -> np.ndarray:
    size = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{size}").ravel().astype(np.int64)


def _blocks(shard: int, lang: str, words: np.ndarray, n: np.ndarray, buckets: int):
    """Rows of phrases (one a line of ``words``) by bucket."""
    at = np.zeros(len(words), np.uint64)
    for column in words.T:
        at = mix64(at + column.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at = (at % np.uint64(buckets)).astype(np.int64)
    order = order_of(at)
    ends = np.searchsorted(at[order], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(ends)):
        take = order[ends[k]:ends[k + 1]]
        yield {"shard": shard, "lang": lang, "bucket": int(k), "m": words.shape[1], "words": _pack(words[take].T.ravel()),
               "n": _pack(n[take])}


def _pairs(buckets: int):
    """A shard's pairs of frequent words, and its text in global ids."""
    def run(key, shard: pa.Table, vocabulary: pa.Table) -> pa.Table:
        if not shard.num_rows or not vocabulary.num_rows:
            return _BLOCKS.empty_table()
        tokens, lang = _unpack(shard.column("tokens")[0].as_py()), shard.column("lang")[0].as_py()
        local = np.concatenate([_unpack(x.as_py()) for x in vocabulary.column("ids")])
        known = np.concatenate([_unpack(x.as_py()) + b.as_py() for x, b in zip(vocabulary.column("numbers"), vocabulary.column("before"))])
        by = np.argsort(known)
        local, known = local[by], known[by]
        dense = np.zeros(int(max(tokens.max(), local.max())) + 1, np.int64)
        dense[local] = np.arange(1, len(local) + 1)
        text = dense[tokens]
        number = key[0].as_py()
        out = [{"shard": number, "lang": lang, "tokens": _pack(text), "known": _pack(known)}]
        for words, n, *_ in phrases(text, 2):
            if words.shape[1] == 2 and len(n):
                out += _blocks(number, lang, known[words - 1], n, buckets)
        return pa.Table.from_pylist(out, schema=_BLOCKS)
    return run


def _runs(text: np.ndarray, pairs: np.ndarray, least: int) -> np.ndarray:
    """The text's stretches of ``least`` words or more in which every two
    neighbours are one of the pairs, each ended by a separator."""
    width = int(text.max()) + 1
    pairs = np.sort(pairs[0] * width + pairs[1])
    here = text[:-1] * width + text[1:]
    at = np.minimum(np.searchsorted(pairs, here), len(pairs) - 1)
    linked = (pairs[at] == here) & (text[:-1] > 0)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], linked.view(np.int8), [0]])))
    start, stop = edge[::2], edge[1::2] + 1
    long = stop - start >= least
    start, size = start[long], stop[long] - start[long] + 1
    take = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
    out = text[np.minimum(take, len(text) - 1)]
    out[np.cumsum(size) - 1] = SEPARATOR
    return out


def _longer(depth: int, buckets: int):
    def run(key, shard: pa.Table, back: pa.Table) -> pa.Table:
        if not shard.num_rows or not back.num_rows:
            return _BLOCKS.empty_table()
        text, known = (_unpack(shard.column(c)[0].as_py()) for c in ("tokens", "known"))
        pairs = np.concatenate([_unpack(p.as_py()).reshape(2, -1) for p in back.column("pairs")], axis=1)
        out = []
        for words, n, *_ in phrases(_runs(text, 1 + np.searchsorted(known, pairs), 3), depth):
            if words.shape[1] > 2 and len(n):
                out += _blocks(key[0].as_py(), shard.column("lang")[0].as_py(), known[words - 1], n, buckets)
        return pa.Table.from_pylist(out, schema=_BLOCKS)
    return run


def _grouped(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal lines lie together, and where each kind begins."""
    width = int(words.max()).bit_length()
    if width * words.shape[1] <= 63:
        key = np.zeros(len(words), np.int64)
        for column in words.T:
            key = key << width | column
        order = np.argsort(key, kind="stable")
    else:
        order = np.lexsort(words.T[::-1])
    words = words[order]
    return order, np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]).any(axis=1)]))


def _sum(least: int, back: bool):
    """Sums of a bucket over all shards: the frequent phrases and, for
    ``back``, those of them that each shard holds."""
    def run(table: pa.Table) -> pa.Table:
        out, lengths = [], table.column("m").to_numpy()
        for m in np.unique(lengths):
            rows = table.take(np.flatnonzero(lengths == m))
            parts = [_unpack(b.as_py()).reshape(m, -1).T for b in rows.column("words")]
            size = np.array([len(p) for p in parts])
            words, n = np.concatenate(parts), np.concatenate([_unpack(b.as_py()) for b in rows.column("n")])
            order, first = _grouped(words)
            total = np.add.reduceat(n[order], first)
            some = np.flatnonzero(total >= least)
            langs = np.array(rows.column("lang").to_pylist(), object)
            owner = np.repeat(np.arange(len(size)), size)
            kinds = words[order[first[some]]]
            empty = pa.nulls(len(some))
            out.append(pa.table([pa.array(langs[owner[order[first[some]]]], pa.string()), pa.array(list(kinds), pa.list_(pa.int64())),
                                 pa.array(total[some]), empty.cast(pa.int64()), empty.cast(pa.binary())], schema=_SUMS))
            if back:
                kept = np.zeros(len(words), bool)
                kept[order] = np.repeat(total >= least, np.diff(np.append(first, len(words))))
                ends = np.cumsum(size)
                here = [(shard, _pack(words[i:j][kept[i:j]].T.ravel())) for shard, i, j in
                        zip(rows.column("shard").to_pylist(), (ends - size).tolist(), ends.tolist()) if kept[i:j].any()]
                out.append(pa.Table.from_pylist([{"shard": s, "pairs": p} for s, p in here], schema=_SUMS))
        return pa.concat_tables(out)
    return run


def _types(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary",
             pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _counted(batches):
    """Numbers the words of a partition that is sorted by word, from 1: a row
    for each word, and the ids of each shard's words with their numbers, packed."""
    last, held, rows = 0, {}, 0

    def packed():
        for shard, parts in held.items():
            ids, number = (np.concatenate(x) for x in zip(*parts))
            yield {"shard": shard, "ids": _pack(ids), "numbers": _pack(number)}

    for b in batches:
        if not b.num_rows:
            continue
        first, shard, ids = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("is_first", "shard", "id"))
        number = last + np.cumsum(first)
        last = int(number[-1])
        words = b.filter(pa.array(first)).select(["lang", "word", "f"])
        empty = pa.nulls(words.num_rows)
        yield pa.RecordBatch.from_arrays(
            [*words.columns, pa.array(number[first]), empty.cast(pa.int64()), empty.cast(pa.binary()), empty.cast(pa.binary())],
            schema=_NUMBERS)
        order = np.argsort(shard, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(shard[order]) != 0]))
        for part in np.split(order, starts[1:]):
            held.setdefault(int(shard[part[0]]), []).append((ids[part], number[part]))
        rows += b.num_rows
        if rows > SHARD:
            yield pa.RecordBatch.from_pylist(list(packed()), schema=_NUMBERS)
            held, rows = {}, 0
    if held:
        yield pa.RecordBatch.from_pylist(list(packed()), schema=_NUMBERS)


def _frequent(vocabulary: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The frequent words (lang, word, n, w) with their counts over all shards
    and dense global ids, and the shards' own ids of them: packed rows whose
    numbers follow ``before``.  One shuffle by word; words are numbered in each
    partition, after those of the partitions before (one row for each)."""
    same = W.partitionBy("lang", "word")
    rows = (vocabulary.repartition("lang", "word").sortWithinPartitions("lang", "word")
            .withColumn("at", F.monotonically_increasing_id()).withColumn("f", F.sum("n").over(same))
            .where(F.col("f") >= least)
            .select("shard", "id", "lang", "word", "f", (F.col("at") == F.min("at").over(same)).alias("is_first")))
    known = written(rows.mapInArrow(_counted, _types(_NUMBERS)).withColumn("part", F.spark_partition_id()), "frequent-words")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = known.groupBy("part").agg(F.max("number").alias("k")).select(
        "part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("before"))
    every = known.join(parts, "part")
    words = every.where("word IS NOT NULL").select("lang", "word", F.col("f").alias("n"), (F.col("before") + F.col("number")).alias("w"))
    return words, every.where("ids IS NOT NULL").select("shard", "ids", "numbers", "before")


def collocations(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, cover: int = COVER,
                 top: int | None = TOP, limit: int = SHARD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases
    of 2 to ``depth`` words (all, if None)."""
    shards = written(
        docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
        .mapInArrow(_cut_shards(limit), _types(_SHARDS)), "shards")
    tokens = shards.where("tokens IS NOT NULL").select("shard", "lang", "tokens").toDF("shard", "lang", "tokens")
    vocabulary = shards.where("word IS NOT NULL").select("shard", "lang", "word", "id", "n")
    total = written(vocabulary.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    buckets = 1 + (total.agg(F.sum("n")).first()[0] or 0) // BUCKET
    words, held = _frequent(vocabulary, least)
    pairs = written(tokens.groupBy("shard").cogroup(held.groupBy("shard")).applyInArrow(_pairs(buckets), _types(_BLOCKS)), "pairs")
    found = written(pairs.where("words IS NOT NULL").groupBy("bucket").applyInArrow(_sum(least, depth > 2), _types(_SUMS)),
                    "frequent-pairs")
    every = found.where("words IS NOT NULL").select("lang", "words", "a")
    if depth > 2:
        back = found.where("pairs IS NOT NULL").select("shard", "pairs")
        own = pairs.where("tokens IS NOT NULL").select("shard", "lang", "tokens", "known")
        longer = own.groupBy("shard").cogroup(back.groupBy("shard")).applyInArrow(_longer(depth, buckets), _types(_BLOCKS))
        every = every.union(longer.groupBy("bucket").applyInArrow(_sum(least, False), _types(_SUMS)).select("lang", "words", "a"))
    every = written(every, "phrases")
    scored = _scored(_maximal(every, cover), every.select("words", "a").union(words.select(F.array("w"), "n")), total)
    if top is not None:  # texts are needed only where they can decide a rank
        place = F.rank().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
        scored = scored.withColumn("place", place).where(F.col("place") <= top).drop("place")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = _spelled(scored, words).withColumn("rank", rank.cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _maximal(every: DataFrame, cover: int) -> DataFrame:
    """Phrases without an extension by one word that is as frequent."""
    longer = every.where(F.size("words") > 2).select(
        F.explode(F.array(F.expr("slice(words, 2, size(words) - 1)"), F.expr("slice(words, 1, size(words) - 1)"))).alias("words"),
        F.col("a").alias("longer")).groupBy("words").agg(F.max("longer").alias("longer"))
    return every.join(longer, "words", "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a"))).drop("longer")


def _scored(kept: DataFrame, parts: DataFrame, total: DataFrame) -> DataFrame:
    """lang, words, a, l, r, n, score by the lowest cut; ``parts`` has the
    counts of all frequent phrases and words."""
    cuts = (kept.select("lang", "words", "a", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"))
            .withColumn("left", F.expr("slice(words, 1, k)")).withColumn("right", F.expr("slice(words, k + 1, size(words) - k)"))
            .join(parts.select(F.col("words").alias("left"), F.col("a").alias("l")), "left")
            .join(parts.select(F.col("words").alias("right"), F.col("a").alias("r")), "right")
            .join(total, "lang"))
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide["a"] * wide["n"], wide["l"] * wide["r"])
    low = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")
    return cuts.groupBy("lang", "words", "a", "n").agg(low).select("lang", "words", "a", "low.l", "low.r", "n", "low.score")


def _spelled(scored: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with their text."""
    spelled = (scored.select("words", F.posexplode("words").alias("i", "w")).join(words.select("w", "word"), "w")
               .groupBy("words").agg(F.array_join(F.transform(
                   F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    return scored.join(spelled, "words")


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
g AS (SELECT lang, unnest(flatten([[w[i:i + m - 1] FOR i IN range(1, len(w) - m + 2)] FOR m IN range(1, 6)])) AS g FROM w),
f AS (SELECT lang, g, count(*) AS a FROM g GROUP BY ALL),
c AS (SELECT * FROM f WHERE len(g) > 1 AND a >= 100),
k AS (SELECT c.* FROM c WHERE NOT EXISTS (
  SELECT 1 FROM c x, (SELECT unnest(range(4)) AS o) WHERE x.lang = c.lang AND len(x.g) > len(c.g)
    AND x.g[o + 1:o + len(c.g)] = c.g AND 100 * x.a >= 100 * c.a)),
s AS (SELECT k.lang, k.g, k.a, l.a AS l, r.a AS r, n.n, cut, (1000::HUGEINT * k.a * n.n) // (l.a::HUGEINT * r.a) AS score
  FROM k JOIN (SELECT unnest(range(1, 5)) AS cut) ON cut < len(k.g) JOIN n ON n.lang = k.lang
  JOIN f l ON l.lang = k.lang AND l.g = k.g[1:cut] JOIN f r ON r.lang = k.lang AND r.g = k.g[cut + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
    array_to_string(g, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM b)
SELECT * FROM o WHERE rank <= 2000
"""
