"""Line dedup with windows at every character and no capped candidates."""

import random
from collections import Counter

from pyspark.sql import functions as F

from recspark.llm import line_dedup
from recspark.llm.common import numbered


def grams(line, k=12):
    return {line[i:i + k] for i in range(len(line) - k + 1)} or {line}


def brute_groups(lines):
    """Groups of distinct lines by exact similarity of all pairs."""
    root = {x: x for x in lines}
    sets = {x: grams(x) for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, x in enumerate(lines):
        for y in lines[:i]:
            if 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y]):
                root[find(x)] = find(y)
    groups = {}
    for x in lines:
        groups.setdefault(find(x), set()).add(x)
    return sorted(map(sorted, groups.values()))


def found(spark, lines):
    rows, row = numbered(spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string").coalesce(2))
    groups = {}
    for r in line_dedup.line_groups(rows, row).collect():
        groups.setdefault(r.group, set()).add(lines[r.doc_id])
    return sorted(map(sorted, groups.values()))


def letters(rnd, n, of="abcdefghijklmnop"):
    return "".join(rnd.choice(of) for _ in range(n))


def test_long_lines_without_blanks(spark):
    rnd = random.Random(1)
    lines = ["https://www.example.org/" + letters(rnd, 150) for _ in range(20)]
    lines += [x[:-3] + "xyz" for x in lines[:5]]
    lines += [letters(rnd, 80, "日本語文章の例です𠮷野家") for _ in range(6)]
    lines += [lines[-1] + "終", "short", "shorter", "tiny words", letters(rnd, 5000)]
    assert found(spark, lines) == brute_groups(lines)


def test_crowded_buckets_lose_no_pair(spark, monkeypatch):
    """A bucket of many templated lines of which some are pairs."""
    monkeypatch.setattr(line_dedup, "SALT", 8)
    rnd = random.Random(2)
    stock = letters(rnd, 300)
    lines = []
    for _ in range(60):
        own = letters(rnd, 150)
        lines += [stock + own, stock + own[:-20] + letters(rnd, 20)]
    # one band key for all lines: every pair shares the bucket
    monkeypatch.setattr(line_dedup, "signatures", lambda rows: line_dedup._lines(rows, "_row").select(
        "key", F.lit(0).cast("long").alias("band")))
    want = brute_groups(lines)
    assert Counter(map(len, want)) == {2: 60}
    assert found(spark, lines) == want


def test_one_line_in_two_thousand_near_copies(spark):
    """All in one group, whichever word of the line changed."""
    rnd = random.Random(7)
    line = " ".join(letters(rnd, rnd.randint(2, 9)) for _ in range(70)).split()
    lines = []
    for i in range(2000):
        w = list(line)
        w[rnd.randrange(len(w))] = f"n{i}"
        lines.append(" ".join(w))
    other = [letters(rnd, 200) for _ in range(20)]
    got = found(spark, lines + other)
    assert sorted(map(len, got)) == [1] * 20 + [2000]


def test_window_hashes_follow_windows():
    rnd = random.Random(3)
    lines = [letters(rnd, n, "abcé日𠮷") for n in (1, 2, 11, 12, 13, 63, 64, 75, 140, 1000)] + ["a", "ab", "a" * 50, "a" * 49]
    hashes, begin = line_dedup.window_hashes(lines)
    windows = [[x[i:i + 12] for i in range(len(x) - 11)] or [x] for x in lines]
    assert begin.tolist() == [sum(map(len, windows[:i])) for i in range(len(lines))]
    flat = [w for ws in windows for w in ws]
    assert len(flat) == len(hashes) and len(set(flat)) == len(set(hashes.tolist()))
    assert len({(w, h) for w, h in zip(flat, hashes.tolist())}) == len(set(flat))


def test_keys_are_those_of_spark(spark):
    lines = ["", "a", "é日𠮷 and more", "x" * 1000]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in lines], "x string").select(F.xxhash64("x")).collect()]
    assert got == [line_dedup.line_key(x.encode()) for x in lines]


def test_recall_at_the_threshold():
    """Pairs of lines of similarity 0.8 to 0.82: the share with a common band."""
    rnd = random.Random(11)
    pairs = []
    while len(pairs) < 600:
        x = letters(rnd, rnd.randint(60, 400))
        cut = rnd.randint(1, max(1, len(x) // 8))
        y = x[:-cut] + letters(rnd, cut)
        a, b = grams(x), grams(y)
        if 0.8 <= len(a & b) / len(a | b) <= 0.82:
            pairs.append((x, y))
    a, b = (line_dedup.bands([p[i] for p in pairs]) for i in (0, 1))
    recall = (a == b).any(axis=1).mean()
    print("recall", recall)
    assert recall > 0.97
