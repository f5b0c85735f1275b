"""Toxicity by class-conditional Kneser-Ney bigram models.

Each class c (toxic, ordinary) has an absolutely discounted, interpolated model

    P_c(w | v) = kept_c(v w) / n_c(v)  +  freed_c(v) * P_c(w)
    P_c(w)     = kept_c(w) / n_c       +  freed_c * P(w)

of counts of contexts: a word counts once for each different word before it, a
bigram once for each different word before it, so that a text copied a thousand
times counts once.  P(w) is the backoff that both classes share, the pooled
continuation counts.  Contexts don't grow in proportion to the text, so those of
the larger class are rarefied to the size of the smaller one: a context seen
``n`` times counts ``1 - (1 - 1 / ratio) ** n``, the chance that a sample of
that size has it.  What a count loses to its discount is DISCOUNT contexts (of
a bigram PAIR_DISCOUNT) and ALIKE times what the other class has of the same:
what both classes use alike, or what is too rare to tell, is left to the next
level and in the end to the shared backoff, which judges it alike.  The same
holds for both classes, so there is evidence either way.  A document's ratio is

    mean over its words of  log P_toxic(w | v) - log P_ordinary(w | v)

the difference of the two length-normalised log-likelihoods, less the constant
log(freed_toxic / freed_ordinary) that every word has (so a word that neither
class kept has 0).  A logistic curve turns it into a probability.

Spark counts the trigrams of every labelled training document, from these the
contexts of each bigram, and from these the contexts of each word.  A task that
scores text needs the log ratios of the kept words and bigrams, and for words
before a kept bigram log(freed_toxic(v) / freed_ordinary(v)); all else is 0.
They travel sorted by hash, at 8 or 12 bytes each; none is dropped for want of
room.

Folds: crc32(doc_id as text) mod 5.  Fold 0 is held out; folds 1-3 give the
counts; fold 4 gives the logistic curve, fitted on a fixed-size histogram of
the ratios of all its documents (in-sample ratios would be too sharp).

Edge cases: null and empty texts have no words and ratio 0; a null doc_id is
held out (its fold is unknown) and its label is never read; a document with
several label rows is toxic if any row says so; null labels are skipped;
without any label, or with one class only, every ratio is 0 and every score
``sigmoid(-1)``; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.llm.common import small_batches, texts, written

DISCOUNT = 4.0           # contexts taken off each word of a class
PAIR_DISCOUNT = 8.0      # and off each bigram, of which there are many more
ALIKE = 4.0              # contexts taken off for each that the other class has
UNSEEN = 1 << 20         # contexts that the backoff model adds for words never seen
BINS = 4001              # of the calibration histogram, over ratios -2..2
SPAN = 2.0
FOLDS = 5
FILTER = 24              # bits of a document's hash in the filter of labelled ones

# ASCII letters and digits in lower case, every other ASCII character a blank
_TABLE = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))


def fold(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word: 32-bit hash, hashes of the word before and of the one before
    that (0: none), row."""
    words = [t.lower().encode("utf-8", "replace").translate(_TABLE).split() for t in texts(batch)]
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    h = np.fromiter((zlib.crc32(w) for ws in words for w in ws), dtype=np.uint64, count=int(n.sum()))
    starts = (np.cumsum(n) - n)[n > 0]

    def before(x):
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[starts] = 0
        return out
    v = before(h)
    return h, v, before(v), np.repeat(np.arange(len(words)), n)


def _count(batches):
    """Distinct trigrams of a batch in each class and their number: the bigram
    in ``k``, the word before it and the class in ``u`` (hash * 2 + toxic)."""
    for b in small_batches(batches):
        h, v, u, row = _hashes(b)
        if not len(h):
            continue
        toxic = np.asarray(b.column(b.schema.get_field_index("toxic")), dtype=np.uint64)[row]
        k, u = (v << np.uint64(32)) | h, u * np.uint64(2) + toxic
        order = np.lexsort((u, k))
        k, u = k[order], u[order]
        first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (u[1:] != u[:-1])))
        n = np.diff(np.append(first, len(k)))
        yield pa.RecordBatch.from_arrays([pa.array(k[first].view(np.int64)), pa.array(u[first].view(np.int64)),
                                          pa.array(n)], names=["k", "u", "n"])


def _none(dtype):
    return field(default_factory=lambda: np.zeros(0, dtype))


def _found(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, otherwise: np.ndarray | float) -> np.ndarray:
    """``values`` of the ascending ``keys`` for what is asked, else ``otherwise``."""
    if not len(keys):
        return np.full(len(asked), otherwise) if np.isscalar(otherwise) else otherwise
    own, at = np.unique(asked, return_inverse=True)  # each is looked up once
    place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    return np.where((keys[place] == own)[at], values[place][at], otherwise)


@dataclass
class Model:
    """Log ratios of the words, contexts and bigrams that have one (hashes
    ascending), and the logistic curve."""

    word: np.ndarray = _none(np.uint32)
    log_ratio: np.ndarray = _none(np.float32)          # of each word, in contexts without kept bigrams
    context: np.ndarray = _none(np.uint32)
    freed_ratio: np.ndarray = _none(np.float32)        # added to a word's after this context
    pair: np.ndarray = _none(np.uint64)                # context << 32 | word
    pair_ratio: np.ndarray = _none(np.float32)         # of the word in this context
    slope: float = 25.0
    offset: float = -1.0

    def ratio(self, h: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Log ratios of words by hash, alone or after the words ``before``."""
        alone = _found(self.word, self.log_ratio, h.astype(np.uint32), 0.0)
        if before is None or not len(self.pair):
            return alone
        backed = alone + _found(self.context, self.freed_ratio, before.astype(np.uint32), 0.0)
        return _found(self.pair, self.pair_ratio, (before.astype(np.uint64) << np.uint64(32)) | h, backed)


def _ratios(model: Model, batch: pa.RecordBatch) -> np.ndarray:
    h, v, _, row = _hashes(batch)
    n = np.bincount(row, minlength=batch.num_rows)
    return np.bincount(row, weights=model.ratio(h, v), minlength=batch.num_rows) / np.maximum(n, 1)


def marked(labels: DataFrame) -> DataFrame:
    """One label for each labelled document."""
    return (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
            .agg((F.max("toxic") > 0).cast("int").alias("toxic")))


def class_sizes(labels: DataFrame) -> dict[bool, int]:
    """Labelled documents of the counting folds, by class."""
    rows = (marked(labels).where((fold("doc_id") != 0) & (fold("doc_id") < FOLDS - 1))
            .groupBy("toxic").count().collect())
    return {True: 0, False: 0} | {r["toxic"] > 0: r["count"] for r in rows}


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Training documents (fold not 0) with their label.  A filter of fixed
    size keeps most texts without a label out of the shuffle; the join decides."""
    known = marked(labels)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << FILTER))
    word = F.shiftright(place, 6).alias("_word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    filled = known.groupBy(word).agg(F.bit_or(bit).alias("_bits"))
    train = (docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & (fold("doc_id") != 0))
             .withColumn("_word", word).join(F.broadcast(filled), "_word")
             .where(F.col("_bits").bitwiseAND(bit) != 0).drop("_word", "_bits"))
    return train.join(known.hint("merge"), "doc_id")  # labels grow with the documents


def rarefied(n: F.Column, ratio: float) -> F.Column:
    """Chance that a sample of one in ``ratio`` has what occurs ``n`` times."""
    return F.when(n > 0, 1 - F.pow(F.lit(1 - 1 / ratio), n.cast("double"))).otherwise(0.0)


def _kept(own, other, discount: float):
    """What is left of a class's count: works on numpy arrays."""
    return np.maximum(own - discount - ALIKE * other, 0)


def _counts(train: DataFrame, size: dict[bool, int]) -> DataFrame:
    """(kind, key, t, o, both, nt, no).  Of a word (kind 0): its contexts in each
    class, in both pooled, and those of all bigrams after it in each class.  Of
    a bigram that a class keeps (kind 1): its contexts in each class."""
    by = {"t": max(1.0, size[True] / max(1, size[False])), "o": max(1.0, size[False] / max(1, size[True]))}
    trigrams = (train.select("text", "toxic").mapInArrow(_count, "k long, u long, n long")
                .repartition("k").groupBy("k", "u").agg(F.sum("n").alias("n")))
    own = {"t": F.when(F.col("u") % 2 == 1, F.col("n")).otherwise(0),
           "o": F.when(F.col("u") % 2 == 0, F.col("n")).otherwise(0)}
    bigrams = trigrams.groupBy("k").agg(*[x for c in "to" for x in (
        F.sum(own[c]).alias(f"n{c}"), F.sum(rarefied(own[c], by[c])).alias(c))])
    least = [F.col(a) > PAIR_DISCOUNT + ALIKE * F.col(b) for a, b in ("to", "ot")]
    zero = F.lit(0.0)

    def row(kind, key, *counts):
        return F.struct(F.lit(kind).alias("kind"), key.cast("long").alias("key"),
                        *[c.alias(n) for c, n in zip(counts, ("t", "o", "both", "nt", "no"))])
    rows = F.array(
        row(0, F.expr("k & 4294967295L"), *[rarefied(F.col(f"n{c}"), by[c]) for c in "to"], F.lit(1.0), zero, zero),
        row(0, F.shiftrightunsigned("k", 32), zero, zero, zero, F.col("t"), F.col("o")),
        F.when(least[0] | least[1], row(1, F.col("k"), F.col("t"), F.col("o"), zero, zero, zero)))
    return (bigrams.select(F.explode(rows).alias("r")).where("r is not null").select("r.*")
            .groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in ("t", "o", "both", "nt", "no")]))


def _set_ratios(model: Model, counts: DataFrame) -> bool:
    """The log ratios of a model from its counts; False if a class has no words."""
    words = counts.where("kind = 0 and both > 0")
    total = words.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in ("t", "o", "both")]).first()
    if min(total[0], total[1]) <= 0:
        return False
    kept = words.where(" or ".join(f"{a} > {DISCOUNT} + {ALIKE} * {b}" for a, b in ("to", "ot")))
    word = kept.select("key", "t", "o", "both").toPandas().sort_values("key")
    pair = counts.where("kind = 1").select("key", "t", "o").toPandas()
    key = pair["key"].to_numpy().view(np.uint64)
    left, right = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def of(keys):
        """Rows of these words only, in the order asked."""
        asked = counts.sparkSession.createDataFrame([(int(k),) for k in np.unique(keys)], "key long")
        return counts.where("kind = 0").join(F.broadcast(asked), "key").toPandas().set_index("key").loc[keys]
    free, probability = {}, {}
    for c, other, n in (("t", "o", total[0]), ("o", "t", total[1])):
        mass = _kept(word[c].to_numpy(), word[other].to_numpy(), DISCOUNT) / n
        free[c] = 1 - mass.sum()

        def p(rows, c=c, other=other, n=n):
            shared = (rows["both"].to_numpy() + 1) / (total[2] + UNSEEN)
            return _kept(rows[c].to_numpy(), rows[other].to_numpy(), DISCOUNT) / n + free[c] * shared
        probability[c] = p
    base = math.log(free["t"] / free["o"])
    model.word = word["key"].to_numpy().astype(np.uint32)
    model.log_ratio = (np.log(probability["t"](word)) - np.log(probability["o"](word)) - base).astype(np.float32)
    if not len(key):
        return True
    context, at = np.unique(left, return_inverse=True)
    every, own = of(context), of(right)
    freed, logs = {}, {}
    for c, other in ("to", "ot"):
        n = every[f"n{c}"].to_numpy()
        mass = _kept(pair[c].to_numpy(), pair[other].to_numpy(), PAIR_DISCOUNT)
        mass = np.divide(mass, n[at], out=np.zeros(len(at)), where=n[at] > 0)
        freed[c] = 1 - np.bincount(at, weights=mass, minlength=len(context))
        logs[c] = np.log(mass + freed[c][at] * probability[c](own))
    model.context = context.astype(np.uint32)
    model.freed_ratio = (np.log(freed["t"]) - np.log(freed["o"])).astype(np.float32)
    order = np.argsort(key)
    model.pair = key[order]
    model.pair_ratio = (logs["t"] - logs["o"] - base)[order].astype(np.float32)
    return True


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit both models and the logistic curve (see the module's notes)."""
    spark = docs.sparkSession
    train = labelled(docs, labels).select("doc_id", "text", "toxic")
    model = Model()
    counts = _counts(train.where(fold("doc_id") < FOLDS - 1), class_sizes(labels))
    if not _set_ratios(model, written(counts, "toxic-counts")):
        return model
    shared = spark.sparkContext.broadcast(model)

    def bins(batches):
        """Calibration histogram of a partition: fixed size, whatever it read."""
        hist = np.zeros((2, BINS), np.int64)
        for b in small_batches(batches):
            at = np.rint((np.clip(_ratios(shared.value, b), -SPAN, SPAN) + SPAN) / (2 * SPAN) * (BINS - 1))
            toxic = np.asarray(b.column(b.schema.get_field_index("toxic")), dtype=np.int64)
            np.add.at(hist, ((toxic > 0).astype(int), at.astype(int)), 1)
        y, x = np.nonzero(hist)
        yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(x), pa.array(hist[y, x])], names=["y", "x", "n"])

    rows = (train.where(fold("doc_id") == FOLDS - 1).select("text", "toxic")
            .mapInArrow(bins, "y long, x long, n long").groupBy("y", "x").agg(F.sum("n").alias("n")).collect())
    model.slope, model.offset = logistic([(r["x"] / (BINS - 1) * 2 * SPAN - SPAN, r["y"], r["n"]) for r in rows])
    shared.destroy()
    return model


def logistic(points: list[tuple[float, int, int]], steps: int = 60) -> tuple[float, float]:
    """Slope and offset of P(1 | x) by Newton's method over weighted points,
    with a light ridge on the slope; (25, -1) where a class is missing.  The
    offset is -1 at most: without any evidence a document is ordinary."""
    if len({y for _, y, _ in points}) < 2:
        return 25.0, -1.0
    x, y, n = (np.array(c, dtype=float) for c in zip(*points))
    scale = max(float(np.sqrt((n * x * x).sum() / n.sum())), 1e-9)
    z = np.stack([x / scale, np.ones_like(x)], 1)
    beta, ridge = np.zeros(2), np.diag([1e-6, 1e-6]) * n.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (n * (y - p)) - ridge @ beta
        hess = (z * (n * p * (1 - p))[:, None]).T @ z + ridge
        step = np.linalg.solve(hess, grad)
        beta = beta + step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
    return max(float(beta[0]) / scale, 1e-6), min(float(beta[1]), -1.0)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Every row with its probability of being toxic in column ``out`` (an
    existing column of that name is replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in small_batches(batches, text):
            m = shared.value
            x = m.slope * _ratios(m, b if text == "text" else b.select([text]).rename_columns(["text"])) + m.offset
            p = np.array([1 / (1 + math.exp(-max(-60.0, min(60.0, float(v))))) for v in x])
            keep = [i for i, f in enumerate(b.schema.names) if f != out]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in keep] + [pa.array(p)],
                                             names=[b.schema.names[i] for i in keep] + [out])

    kept = docs.drop(out)
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())])
    return kept.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, held_out, score, predicted for every document."""
    model = fit(docs, labels)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", "text", F.coalesce(fold("doc_id") == 0, F.lit(True)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
