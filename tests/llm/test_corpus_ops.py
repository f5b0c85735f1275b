"""Line dedup, Jaccard join, toxicity, top-k search, components, pipeline."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recspark.llm import components, jaccard_join, line_dedup, topk, toxicity
from recspark.llm.common import numbered

COLUMNS = "doc_id long, text string, source string, lang string, group long, kept_lines long, _row string"


def words(rnd, n, size=400):
    return [f"w{rnd.randrange(size)}x" for _ in range(n)]


def near(rnd, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rnd.randrange(len(w))] = f"new{rnd.randrange(10 ** 6)}"
    return w


def corpus(seed=1):
    """Unrelated texts, families of near copies, a shared passage, exact
    copies, odd rows."""
    rnd = random.Random(seed)
    texts = [" ".join(words(rnd, rnd.randint(30, 90), 5000)) for _ in range(60)]
    for _ in range(6):
        base = words(rnd, 120, 5000)
        texts += [" ".join(near(rnd, base, rnd.randint(0, 6))) for _ in range(12)]
    passage = " ".join(words(rnd, 40, 5000))
    texts += [passage + "\n" + " ".join(words(rnd, 30, 5000)) for _ in range(25)]
    texts += [texts[3]] * 20 + [passage]
    texts += [None, "", " \n ", "one", "one", "two words here", "x " * 3000, "\n\n" + texts[5]]
    rows = [(i, t, ["a", "b", None][i % 3], "en", 1, 2, "r") for i, t in enumerate(texts)]
    return rows + [rows[3], (None, texts[7], None, None, None, None, None), (None, None, None, None, None, None, None)]


def union(n):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    return find, lambda a, b: parent.__setitem__(max(find(a), find(b)), min(find(a), find(b)))


def shingles(text, k=5):
    w = [x for x in re.split(r"[ \t\n\x0b\x0c\r]+", "".join(c.lower() if c < "\x80" else c for c in text or "")) if x]
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def groups_by_brute_force(sets):
    find, join = union(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                join(i, j)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("small,rounds", [(8, 1), (8, 2), (2, 1), (2, 3)])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, small, rounds):
    monkeypatch.setattr(jaccard_join, "SMALL", small)  # more recursion, same result
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "HOT", 3)
    monkeypatch.setattr(jaccard_join, "CROWD", 4 * small)
    rows = corpus()
    sets = [shingles(r[1]) for r in rows]
    root = groups_by_brute_force(sets)
    least = defaultdict(list)
    for r, g in zip(rows, root):
        least[g].append(r[0])
    want = Counter()
    for r, s, g in zip(rows, sets, root):
        ids = [d for d in least[g] if d is not None]
        want[r[0], len(s), min(ids) if ids and s else r[0]] += 1
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df).collect())
    assert got == want


def test_jaccard_keeps_one_of_each(spark):
    rows = corpus(2)
    sets = [shingles(r[1]) for r in rows]
    root = groups_by_brute_force(sets)
    df = spark.createDataFrame(rows, COLUMNS)
    kept = jaccard_join.one_of_each(df)
    assert kept.columns == df.columns
    n = len({g for g, s in zip(root, sets) if s}) + sum(not s for s in sets)
    assert kept.count() == n
    assert jaccard_join.one_of_each(df.limit(0)).count() == 0


def test_parity_sketch_is_a_lower_bound():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2 ** 63, 800).astype(np.uint64))
        b = np.unique(np.r_[a[:rng.integers(0, len(a))], rng.integers(0, 2 ** 63, rng.integers(0, 300)).astype(np.uint64)])
        bits = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in jaccard_join._sketch(a) ^ jaccard_join._sketch(b))
        assert bits <= len(np.setxor1d(a, b))


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(200, 260)] + [(7, 7)]
    edges += [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(120)]
    find, join = union(1200)
    for a, b in edges:
        join(a, b)
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def grams(line, k=12):
    return {line[i:i + k] for i in range(len(line) - k + 1)} or {line}


def brute_lines(rows):
    """Remaining texts by exact Jaccard similarity of all pairs of lines."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    lines = [(i, p, line) for i in order for p, line in enumerate((rows[i][1] or "").split("\n"))
             if re.search(r"[^\x20\x09-\x0D]", line)]
    distinct = list(dict.fromkeys(line for *_, line in lines))
    root = dict(zip(distinct, groups_by_brute_force([frozenset(grams(x)) for x in distinct])))
    seen, gone = set(), defaultdict(set)
    for i, p, line in lines:
        if root[line] in seen:
            gone[i].add(p)
        seen.add(root[line])
    out = []
    for i, r in enumerate(rows):
        text = r[1] if r[1] is None else "\n".join(x for p, x in enumerate(r[1].split("\n")) if p not in gone[i])
        out.append((r[0], text))
    return out


def line_corpus():
    rnd = random.Random(6)
    base = [" ".join(words(rnd, 25, 3000)) for _ in range(30)]
    rows = []
    for i in range(40):
        own = [" ".join(words(rnd, 20, 3000)) for _ in range(3)]
        shared = [" ".join(near(rnd, rnd.choice(base).split(), rnd.choice([0, 0, 1]))) for _ in range(2)]
        text = "\n".join(rnd.sample(own + shared + ["", "short"], 6))
        rows.append((i, text, "a", "en", 1, 9, "r"))
    rows += [(40, None, None, None, None, None, None), (41, "", "a", "en", 1, 1, "x"), (42, " \n\t", "a", "en", 1, 1, "x"),
             (43, "long line " * 5000, "a", "en", 1, 1, "x"), (None, base[0] + "\nonly here", "a", "en", 1, 1, "x")]
    return rows + [rows[2]]


def test_line_dedup_equals_brute_force(spark):
    rows = line_corpus()
    df = spark.createDataFrame(rows, COLUMNS).coalesce(1)
    got = line_dedup.deduped(df)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(brute_lines(rows))
    out = line_dedup.dedup_lines(df)
    assert out.columns == df.columns and out.where("doc_id = 41 or doc_id = 42 or doc_id = 40").count() == 3
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def toxic_corpus(n=1500, seed=8):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.2
        w = words(rnd, rnd.randint(40, 200), 2000)
        if toxic:
            for _ in range(max(2, len(w) // 25)):
                w.insert(rnd.randrange(len(w)), rnd.choice(["vile", "nasty", "rotten", "foul"]))
        docs.append((i, " ".join(w), "score"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_held_out(spark):
    docs, labels = toxic_corpus()
    extra = [(5000, None, "x"), (5001, "", "x"), (None, "vile " * 30, "x"), docs[0]]
    d = spark.createDataFrame(docs + extra, "doc_id long, text string, score string").repartition(3)
    lab = spark.createDataFrame(labels + [(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(d, lab).collect()
    assert len(got) == len(docs) + len(extra)
    mark = {i: t for i, _, t in labels}
    held = [(r.predicted, mark[r.doc_id]) for r in got if r.held_out and r.doc_id in mark]
    assert len(held) > 200 and sum(p == t for p, t in held) / len(held) > 0.95
    by_id = {r.doc_id: r for r in got}
    assert by_id[5000].score == by_id[5001].score < 0.5 and by_id[None].predicted == 1 and by_id[None].held_out
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    # labels of held-out documents change nothing
    flipped = [(i, q, 1 - t) if toxicity.zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t) for i, q, t in labels]
    again = toxicity.toxicity(d, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_toxicity_without_labels(spark):
    d = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.toxicity(d, none).collect()} == {0}
    assert toxicity.toxicity(d.limit(0), none).count() == 0


@pytest.mark.parametrize("scale", [1.0, 900.0, 1e7])
def test_topk_equals_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "ROW_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(7)
    x = (rng.normal(size=(230, 6)) * scale).round(3)
    x[50:120] = x[50]  # many ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows + rows[:9] + bad, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score)
           for r in topk.top_k(topk.vectors(df), F.col("vec_id") % 20 == 0, k=20).collect()}
    v = [[int(np.floor(64 * c)) for c in r] for r in x]
    want = {}
    for q in range(0, 230, 20):
        s = sorted((-sum(a * b for a, b in zip(v[q], v[i])), i) for i in range(230) if i != q)[:20]
        want |= {(q, rank): (i, -n) for rank, (n, i) in enumerate(s, 1)}
    assert got == want
    assert topk.top_k(topk.vectors(df.limit(0)), F.col("vec_id") % 20 == 0).count() == 0


def test_pipeline_stages(spark):
    """Every stage on its own input, against brute force where it decides."""
    tox, labels = toxic_corpus(900, 3)
    rows = [(i, t, ["s1", "s2", None][i % 3], "en", len(t)) for i, t, _ in tox]
    rows += [(1000 + r[0], r[1], r[2] or "s0", "en", 0) for r in corpus(5) if r[0] is not None]
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    import tempfile
    sf = tempfile.mkdtemp(prefix="pipeline-")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    now = spark.read.parquet(f"{sf}/documents.parquet")
    before = now.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, now, sf), name)
        assert out.columns == docs.columns
        ids, rest = Counter(r.doc_id for r in now.collect()), Counter(r.doc_id for r in out.collect())
        assert set(rest) <= set(ids)
        if name == "toxicity":
            mark = {i: t for i, _, t in labels}
            lost = set(ids) - set(rest)
            clean = sum(not mark.get(i, 0) for i in lost)
            assert clean <= 0.03 * len(ids) and len(lost) - clean > 0.7 * sum(mark.values())
        if name == "line_dedup":
            listed = [(r.doc_id, r.text) for r in now.collect()]
            left = Counter(x for x in brute_lines(sorted(listed, key=lambda x: (x[0], x[1] or "")))
                           if (x[1] or "").strip() or not (dict(listed)[x[0]] or "").strip())
            got = Counter((r.doc_id, r.text) for r in out.collect())
            assert got == left
        if name == "jaccard_join":
            sets = [shingles(r.text) for r in now.collect()]
            assert out.count() == len({g for g, s in zip(groups_by_brute_force(sets), sets) if s}) + sum(not s for s in sets)
        if name == "mixing":
            size = Counter()
            for r in now.collect():
                size[r.source] += len((r.text or "").split())
            got = Counter()
            for r in out.collect():
                got[r.source] += len((r.text or "").split())
            assert max(rest.values()) <= 2 and abs(sum(got.values()) - 1.5 * sum(size.values())) < 0.1 * sum(size.values())
        now = out
    pieces = corpus_pipeline.packing_stage(spark, now, sf)
    per_doc = {r.doc_id: r["n"] for r in pieces.groupBy("doc_id").agg(F.countDistinct("start").alias("n")).collect()}
    assert set(per_doc) == {r.doc_id for r in now.collect()} and before > len(per_doc)
    assert corpus_pipeline.run(spark, sf).count() == pieces.count()


def test_one_large_group_of_near_copies(spark):
    """Thousands of candidate pairs around the threshold in one region."""
    rnd = random.Random(9)
    base = words(rnd, 150, 5000)
    texts = [" ".join(near(rnd, base, rnd.randint(0, 4))) for _ in range(400)]
    find, join = union(len(texts))
    sets = [shingles(t) for t in texts]
    for i in range(len(sets)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                join(i, j)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(df).collect()}
    assert got == {i: find(i) for i in range(len(texts))}
