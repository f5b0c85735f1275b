"""Texts are read again for the pairs that are compared; no table holds those of all documents that meet."""

import random

from recspark.llm import jaccard_join as J


def brute(docs):
    sets = []
    for _, text in docs:
        words = (text or "").lower().split()
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    root = list(range(len(docs)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    least = {}
    for (d, _), r, s in zip(docs, root, sets):
        if s and d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(s), least.get(r) if s else d) for (d, _), r, s in zip(docs, root, sets)), key=str)


def made():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    common = " ".join(words[:8])                       # all texts meet here, few are near copies
    docs = [(i, f"{common} {' '.join(rng.choices(words, k=40))}") for i in range(60)]
    docs += [(100 + i, docs[i % 7][1] + f" end{i}") for i in range(30)]
    return docs + [docs[0], docs[3], (None, docs[3][1]), (None, docs[9][1] + " x"), (200, None), (201, ""), (202, "a b")]


def test_only_compared_texts_are_written(spark, monkeypatch):
    docs, seen = made(), {}
    write = J.written

    def written(df, name):
        out = write(df, name)
        seen.setdefault(name, []).append(out)
        return out
    monkeypatch.setattr(J, "written", written)
    rows = J.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows.collect()), key=str) == brute(docs)
    assert "text" not in seen["members"][0].columns
    assert seen["members"][0].count() > 60
    assert all(t.count() < 60 for t in seen["candidates"])


def test_the_filter_keeps_what_is_wanted(spark, monkeypatch):
    monkeypatch.setattr(J, "FILTER", 6)                # so small that others pass, too
    docs, plain = made(), J.jaccard_components
    rows = plain(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows.collect()), key=str) == brute(docs)
