"""The models score bigrams, and evidence for either class counts."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from recspark.llm import toxicity as X

FILL = [f"w{i}" for i in range(40)]


def corpus(n=700, seed=5):
    """Every document has the same words; only their order marks a toxic one.
    Ordinary ones alone use "calm"."""
    rnd, docs, labels = random.Random(seed), [], []
    for i in range(n):
        toxic = rnd.random() < 0.4
        words = [rnd.choice(FILL) for _ in range(30)]
        for at in (24, 16, 8):
            words[at:at] = ["go", "away"] if toxic else ["away", "go"]
        if not toxic:
            words.insert(4, "calm")
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    docs += [(1000, "w1 w2 w3 calm w4 calm"), (1001, "w1 w2 w3 away go"), (1002, "w1 w2 w3 go away")]
    return docs, labels


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, labels, d, X.fit(d, lab)


def brute(docs, labels):
    """log P_toxic(w | v) - log P_ordinary(w | v), less its constant, by dictionaries."""
    mark = {i: t for i, _, t in labels}
    use = [(t.split(), mark[i]) for i, t in docs if i in mark and 0 < fold(i) < 4]
    tri = {1: Counter(), 0: Counter()}
    for words, y in use:
        p = [None, None, *words]
        tri[y].update(zip(p, p[1:], p[2:]))
    size = Counter(t for i, _, t in labels if 0 < fold(i) < 4)
    pair, word, pooled = {}, {}, defaultdict(set)
    for y in (0, 1):
        r = max(1, size[y] / size[1 - y])
        pair[y], word[y], two = Counter(), Counter(), Counter()
        for (u, v, w), n in tri[y].items():
            pair[y][v, w] += 1 - (1 - 1 / r) ** n
            two[v, w] += n
            pooled[w].add(v)
        for (v, w), n in two.items():
            word[y][w] += 1 - (1 - 1 / r) ** n
    total, both = {y: sum(word[y].values()) for y in word}, sum(map(len, pooled.values()))

    def kept(table, y, key, discount):
        return max(table[y][key] - discount - X.ALIKE * table[1 - y][key], 0)
    free = {y: 1 - sum(kept(word, y, w, X.DISCOUNT) for w in word[y]) / total[y] for y in word}

    def p(y, v, w):
        one = kept(word, y, w, X.DISCOUNT) / total[y] + free[y] * (len(pooled[w]) + 1) / (both + X.UNSEEN)
        n = sum(c for (a, _), c in pair[y].items() if a == v)
        if not n:
            return one
        left = sum(kept(pair, y, k, X.PAIR_DISCOUNT) for k in pair[y] if k[0] == v) / n
        return kept(pair, y, (v, w), X.PAIR_DISCOUNT) / n + (1 - left) * one
    return lambda v, w: math.log(p(1, v, w) / p(0, v, w)) - math.log(free[1] / free[0])


def test_word_order_is_found(spark, fitted):
    docs, labels, d, model = fitted
    mark = {i: t for i, _, t in labels}
    got = [(r.score >= 0.5, mark[r.doc_id]) for r in X.score(d, model).collect()
           if r.doc_id in mark and fold(r.doc_id) == 0]
    assert sum(p for p, t in got if t) >= 0.9 * sum(t for _, t in got) > 40
    assert sum(p for p, t in got if not t) <= 0.05 * len(got)


def test_evidence_for_the_ordinary_class_counts(spark, fitted):
    _, _, d, model = fitted
    score = {r.doc_id: r.score for r in X.score(d, model).collect() if r.doc_id >= 1000}
    none = 1 / (1 + math.exp(-model.offset))
    assert score[1000] < none and score[1001] < score[1002] and score[1002] > none


def test_ratios_equal_brute_force(fitted):
    docs, labels, _, model = fitted
    truth = brute(docs, labels)
    pairs = [("go", "away"), ("away", "go"), ("w1", "calm"), ("go", "w3"), ("away", "w3"), ("w1", "w2"),
             ("w1", "never"), ("never", "calm"), (None, "w1")]
    code = [[0 if w is None else zlib.crc32(w.encode()) for w in side] for side in zip(*pairs)]
    got = model.ratio(np.array(code[1], np.uint64), np.array(code[0], np.uint64))
    assert np.allclose(got, [truth(*x) for x in pairs], atol=1e-4)
    assert got[0] > 1 and got[1] < -1 and got[2] < -1
