"""Quality rules combined by weak supervision.

Rules look at cheap features of a text and vote good (1), bad (0) or abstain.
They are deliberately touchy (a rule alone is often wrong on clean documents) and
overlap, so that most junk draws several bad votes.  Instead of asking that all
rules pass, a generative model weighs them: each rule votes bad with one unknown
probability on bad documents and with another on good ones, independently given
the class, and expectation-maximisation finds these and the share of good
documents that best explain the votes of the whole corpus.  An abstention is a
missing vote and says nothing.  A document is kept if its posterior probability
of being good reaches ``KEEP``; a bad vote of a rule that the corpus shows to be
unreliable is outweighed by the others.

Spark computes the votes of every text and counts each combination of votes;
there are at most 3 ** rules combinations, whatever the corpus, so EM runs on
these counts (as it would on the documents one by one) and the posteriors go
back as a table of that size.

Features (words are runs of non-blank characters): n_words, word_chars,
n_symbols (of ``SYMBOLS``), n_dup_lines (lines with a word that equal an
earlier line), n_repeat_words (words in three-word windows that occur twice or
more), n_caps (words of two letters or more in capitals), n_bars (words
without a letter or digit), n_odd (ASCII capitals, digits and punctuation).

The base rule stays a hard one: fewer than 50 words, or more than half of the
words in repeated windows, fails at once; such rows vote too, so that the
corpus statistics cover all rows.

Edge cases: a null or empty text has no words, every rule abstains or votes
bad, and the base rule fails; repeated rows count as often as they occur; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import cut, small_batches, texts

SYMBOLS = "#*$%&|<>"
KEEP = 0.5
ROUNDS = 500
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_caps", "n_bars", "n_lines", "n_odd")
_ODD = (string.ascii_uppercase + string.digits + string.punctuation).encode()
_BLANKS = " \t\n\x0b\x0c\r"


def features(text: str) -> tuple[int, ...]:
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    dup = lines = 0
    if "\n" in text:
        seen = set()
        for line in text.split("\n"):
            if line.strip(_BLANKS):
                lines += 1
                dup += line in seen
                seen.add(line)
    else:
        lines = int(n > 0)
    repeat = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        count = Counter(windows)
        end = 0
        for i, w in enumerate(windows):
            if count[w] > 1:
                repeat += i + 3 - max(i, end)
                end = i + 3
    caps = sum(w.isupper() and len(w) > 1 for w in words)
    bars = sum(len(w) == 1 and not w.isalnum() and w < b"\x80" for w in words)
    return (n, len(text) - sum(map(text.count, _BLANKS)), sum(map(text.count, SYMBOLS)), dup, repeat, caps, bars, lines,
            len(raw) - len(raw.translate(None, _ODD)))


def _features(batches):
    for b in small_batches(batches):
        rows = list(zip(*map(features, texts(b))))
        yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(r, pa.int64()) for r in rows],
                                         names=["doc_id", *FEATURES])


def _vote(bad, good) -> F.Column:
    return F.when(bad, 0).when(good, 1)


def rules() -> dict[str, F.Column]:
    """Name -> vote (null: abstains).  Integer arithmetic throughout."""
    n, c = F.col("n_words"), F.col
    return {
        "length": _vote(n < 100, n >= 200),
        "word_length": _vote((10 * c("word_chars") < 46 * n) | (10 * c("word_chars") > 56 * n),
                             (n >= 20) & (10 * c("word_chars") >= 47 * n) & (10 * c("word_chars") <= 55 * n)),
        "symbols": _vote(10 * c("n_symbols") > n, (n >= 20) & (50 * c("n_symbols") < n)),
        "dup_lines": _vote(2 * c("n_dup_lines") > c("n_lines"), (c("n_lines") >= 2) & (c("n_dup_lines") == 0)),
        "repeats": _vote(10 * c("n_repeat_words") > 3 * n, (n >= 20) & (20 * c("n_repeat_words") < n)),
        "capitals": _vote(10 * c("n_caps") > n, (n >= 20) & (50 * c("n_caps") < n)),
        "bars": _vote(50 * c("n_bars") > n, (n >= 20) & (200 * c("n_bars") < n)),
        "odd": _vote(100 * c("n_odd") > 12 * c("word_chars"), (n >= 20) & (100 * c("n_odd") <= 8 * c("word_chars"))),
    }


# weak priors, in votes and documents: they only say which class is which
PRIOR_VOTES = ((2.0, 2.0), (0.4, 3.6))  # bad and good votes of each rule on bad documents, on good ones
PRIOR_DOCS = (2.0, 2.0)                 # bad and good documents


def em(votes: np.ndarray, count: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of each vote combination (rows: 0 bad, 1 good, 2 abstain),
    P(bad vote | class, vote cast) as [class, rule] and the share of good
    documents; starts from the share of good votes of each combination."""
    bad, good = (votes == 0).astype(float), (votes == 1).astype(float)
    p = (good.sum(1) + 1) / (good.sum(1) + bad.sum(1) + 2)
    rate, share = np.zeros((2, votes.shape[1])), 0.5
    for _ in range(rounds):
        share = float((count @ p + PRIOR_DOCS[1]) / (count.sum() + sum(PRIOR_DOCS)))
        rate = np.stack([(w @ bad + b) / (w @ (bad + good) + b + g)
                         for w, (b, g) in zip((count * (1 - p), count * p), PRIOR_VOTES)])
        log = [bad @ np.log(r) + good @ np.log(1 - r) for r in rate]
        odds = log[1] - log[0] + np.log(share / (1 - share))
        old, p = p, 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        if np.abs(p - old).max() < 1e-9:
            break
    return p, rate, share


def quality(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """doc_id, the features, base_failed, p_good and kept for every row."""
    spark = docs.sparkSession
    found = docs.select("doc_id", "text").mapInArrow(
        _features, ", ".join([f"doc_id {docs.schema['doc_id'].dataType.simpleString()}", *(f"{f} long" for f in FEATURES)]))
    named = rules()
    pattern = F.concat(*[F.coalesce(v.cast("string"), F.lit("-")) for v in named.values()])
    rows = cut(found.withColumn("votes", pattern))
    table = [(r["votes"], r["n"]) for r in rows.groupBy("votes").agg(F.count("*").alias("n")).collect()]
    if table:
        matrix = np.array([[{"0": 0, "1": 1, "-": 2}[v] for v in votes] for votes, _ in table])
        p, _, _ = em(matrix, np.array([n for _, n in table], dtype=float))
        table = [(votes, float(x)) for (votes, _), x in zip(table, p)]
    posterior = spark.createDataFrame(table, "votes string, p_good double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (rows.join(F.broadcast(posterior), "votes")  # at most 3 ** rules rows
            .withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("p_good") >= keep)))
