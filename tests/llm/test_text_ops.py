"""Quality rules, token files, license scan, packing, sharding, mixing."""

import random
import tempfile
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from tokenizers import Tokenizer

from recspark.llm import licenses, mixing, packing, quality, rangecoder, sharding, token_files, tokens

COLUMNS = "doc_id long, text string, source string, size long, shard string, _row string, score string, key string"


def odd_rows():
    """Nulls in any column, empty, blank and very long texts, ties, repeated
    rows, and extra columns with clashing names."""
    rnd = random.Random(5)
    words = ["the", "mit", "license", "under", "naïve", "日本語", "x#", "a|b", "don't"]
    long = " ".join(rnd.choice(words) for _ in range(60_000))
    texts = [None, "", "  \n\t ", "one", "under the MIT\nlicense, under THE mit license", long, "same text here " * 30,
             "same text here " * 30, "a\x85b \x1c c d", "<|endoftext|> end"]
    rows = [(i, t, ["b", "a", None][i % 3], 1, "s", None, "z", "k") for i, t in enumerate(texts)]
    return rows + [rows[6], rows[6], (None, "no id", None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def ids_of(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def test_tokens_equal_the_library():
    texts = [r[1] or "" for r in odd_rows()] + ["  two  spaces \n\n x", "ÀÉ²³ ½ ª", "12 34abc 'll we've"]
    e = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == [ids_of(t) for t in texts]
    old, tokens.CACHE = tokens.CACHE, 4  # a full cache changes nothing
    try:
        e = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
        for _ in range(2):
            assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == [ids_of(t) for t in texts]
            assert len(e.kept) <= 4
    finally:
        tokens.CACHE = old


def test_range_coder_round_trips_and_checks():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0), np.zeros(5000), rng.integers(0, 65536, 7001), rng.zipf(1.3, 9000) % 50257, [7]):
        ids = np.asarray(ids, dtype="<u4")
        payload = rangecoder.encode(ids, block=1000)
        assert (rangecoder.decode(payload) == ids).all()
    assert len(rangecoder.encode(np.zeros(20000, "<u4"))) < 400
    bad = bytearray(rangecoder.encode(rng.integers(0, 50000, 3000)))
    bad[-5] ^= 1
    with pytest.raises(ValueError):
        rangecoder.decode(bytes(bad))
    with pytest.raises(ValueError):
        rangecoder.encode([1 << 16])


def test_token_files(spark, odd, none):
    d = tempfile.mkdtemp(prefix="ids-") + "/ids"
    token_files.write_ids(odd, d, frame_ids=1000)
    got = sorted((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in token_files.read_ids(spark, d).collect())
    at, want = 0, Counter()
    for start, doc, n, ids in got:
        assert start == at and n == len(ids) // 4
        at += n
        want[doc, ids] += 1
    assert want == Counter((r[0], np.array(ids_of(r[1]) + [2], "<u4").tobytes()) for r in odd_rows())
    order = [g[1] for g in got]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    assert token_files.token_files(none).count() == 0


def brute_quality(text):
    w = (text or "").encode().split()
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(win)
    hit = {j for i, x in enumerate(win) if c[x] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    chars = sum(ch not in " \t\n\x0b\x0c\r" for ch in text or "")
    return len(w), chars, sum((text or "").count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_quality_base_and_verdict(spark, odd, none):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality.quality(odd).collect())
    want = Counter()
    for r in odd_rows():
        f = brute_quality(r[1])
        want[(r[0], *f, f[0] < 50 or 100 * f[4] > 50 * f[0])] += 1
    assert got == want
    assert quality.quality(none).count() == 0
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 8)))
    clean = [" ".join(word() for _ in range(150)) for _ in range(300)]
    junk = [" ".join(word().upper() for _ in range(150)) for _ in range(12)] + \
           [" ".join(word() + "%%%" for _ in range(150)) for _ in range(12)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(clean + junk)], "doc_id long, text string")
    kept = {r.doc_id for r in quality.quality(df).where("kept").collect()}
    assert kept == set(range(300))


def planted_votes(n, seed, rates=(0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6)):
    """Classes of n documents and votes of rules of these accuracies, a fifth abstained."""
    rng = np.random.default_rng(seed)
    good = rng.random(n) < 0.6
    right = rng.random((n, len(rates))) < np.array(rates)
    votes = np.where(right, good[:, None], ~good[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.2] = 2
    return good, votes, np.array(rates)


def test_em_finds_planted_accuracies():
    good, votes, rates = planted_votes(50_000, 1)
    kinds, which, count = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p, rate, share = quality.em(kinds, count.astype(float))
    assert abs(rate[1] - (1 - rates)).max() < 0.05 and abs(rate[0] - rates).max() < 0.05 and abs(share - 0.6) < 0.05
    score = (votes == 1).sum(1) - (votes == 0).sum(1)
    assert ((p[which] >= 0.5) == good).mean() >= ((score >= 0) == good).mean()


def test_em_over_combinations_equals_em_over_documents():
    """Document by document, with plain loops, as many rounds."""
    _, votes, _ = planted_votes(300, 2, (0.9, 0.8, 0.7))
    votes = votes.tolist()
    p = [(v.count(1) + 1) / (v.count(1) + v.count(0) + 2) for v in votes]
    for _ in range(5):
        share = (sum(p) + quality.PRIOR_DOCS[1]) / (len(p) + sum(quality.PRIOR_DOCS))
        rate = []
        for k, (b, g) in enumerate(quality.PRIOR_VOTES):
            row = []
            for r in range(3):
                cast = [(x if k else 1 - x, v[r]) for x, v in zip(p, votes) if v[r] != 2]
                row.append((sum(w for w, v in cast if v == 0) + b) / (sum(w for w, _ in cast) + b + g))
            rate.append(row)
        new = []
        for v in votes:
            like = [1 - share, share]
            for k in (0, 1):
                for r in range(3):
                    like[k] *= 1 if v[r] == 2 else rate[k][r] if v[r] == 0 else 1 - rate[k][r]
            new.append(like[1] / sum(like))
        p = new
    kinds, which, count = np.unique(np.array(votes), axis=0, return_inverse=True, return_counts=True)
    got, *_ = quality.em(kinds, count.astype(float), rounds=5)
    assert np.abs(got[which] - np.array(p)).max() < 1e-9


def test_verdict_beats_all_must_pass(spark):
    """On labelled documents, those that the base rule passes."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    named = F.concat(*[F.coalesce(v.cast("string"), F.lit("-")) for v in quality.rules().values()])
    rows = (quality.quality(docs).withColumn("votes", named).where("not base_failed")
            .join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id")
            .select("kept", "votes", "quality").collect())
    right = sum(r.kept == bool(r.quality) for r in rows) / len(rows)
    strict = sum(("0" not in r.votes) == bool(r.quality) for r in rows) / len(rows)
    assert right > 0.99 > 0.95 > strict


def test_licenses(spark, odd, none):
    rows = {r.doc_id: r for r in licenses.license_scan(odd).collect()}
    r = rows[4]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (8, 2, 0, 4, "mit")
    assert rows[0].n_words == 0 and rows[0].labels == "" and rows[0].first_word is None and rows[0].score == 0
    assert licenses.license_scan(none).count() == 0
    rnd = random.Random(3)
    vocabulary = sorted({w for t in licenses.TEMPLATES for w in t.split()}) + ["x", "y"]
    blocks = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 18))) for _ in range(400)]
    for t in licenses.TEMPLATES:  # the templates with words lost and added
        for _ in range(20):
            w = t.split() + ["x"]
            del w[rnd.randrange(len(w))]
            rnd.shuffle(w)
            blocks.append(" ".join(w[rnd.randint(0, 2):]))
    blocks += [" ".join([*b.split(), *["x"] * rnd.randint(0, 9), *c.split()]) for b, c in zip(blocks, blocks[1:])]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(blocks)], "doc_id long, text string")
    for r in licenses.license_scan(df).collect():
        held, best, words = set(r.base_labels.split(",")) - {""}, 0.0, blocks[r.doc_id].split()
        for t, label in licenses.TEMPLATES.items():
            size, t = -(-5 * len(t.split()) // 4), set(t.split())
            n = max(len(t & set(words[i:i + size])) for i in range(max(1, len(words))))
            if 100 * n >= 80 * len(t):
                held.add(label)
                best = max(best, n / len(t))
        assert set(r.labels.split(",")) - {""} == held and (r.n_base or abs(r.score - best) < 1e-12)


def test_licenses_across_line_breaks(spark):
    texts = {
        "bsd": "Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided",
        "gpl-3": "// This program is free software: you can\n// redistribute it and/or\n// modify it under",
        "mit": "Permission is hereby\ngranted, free of charge,\nto any person obtaining\na copy of this\nsoftware and",
        "": "all " + "word " * 200 + "rights " + "word " * 200 + "reserved",
    }
    df = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.license_scan(df).collect()}
    assert [got[i][0] for i in range(4)] == list(texts) and got[3][1] == 0 and got[0][1] == 1


def test_packing(spark, odd, none):
    got = packing.pack(odd).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in got:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    for seq in by_seq.values():
        seq.sort(key=lambda p: p.offset)
        assert [p.offset for p in seq] == np.cumsum([0] + [p.length for p in seq])[:-1].tolist()
        n = sum(p.length for p in seq)
        assert n == 2048 or n & (n - 1) == 0 and n < 2048
    copies = Counter(r[0] for r in odd_rows())
    texts = {r[0]: r[1] for r in odd_rows()}
    for doc, ps in by_doc.items():
        ids = np.array(ids_of(texts[doc]) + [1], "<u4")
        assert sum(p.length for p in ps) == copies[doc] * len(ids)
        cover = np.zeros(len(ids), int)
        for p in ps:
            assert bytes(p.ids) == ids[p.start:p.start + p.length].tobytes() and p.doc_tokens == len(ids)
            cover[p.start:p.start + p.length] += 1
        assert (cover == copies[doc]).all()
    assert set(by_doc) == set(texts) and packing.pack(none).count() == 0


def test_nnls_and_layout():
    rng = np.random.default_rng(4)
    a, x = rng.random((20, 40)), np.abs(rng.normal(size=40)) * (rng.random(40) < 0.2)
    assert np.allclose(a @ packing.nnls(a, a @ x), a @ x, atol=1e-6)
    count = {2048: 5} | {32 * int(q): int(rng.integers(1, 400)) for q in range(1, 64)} | {t: 37 for t in range(1, 32)}
    layout, fill = packing.Layout(count), defaultdict(list)
    for size, n in count.items():
        for rank in range(n):
            parts = layout.place(size, rank)
            assert sum(p[1] for p in parts) == size
            for _, length, seq, at in parts:
                fill[seq].append((at, length))
    for spans in fill.values():
        spans.sort()
        total = sum(n for _, n in spans)
        assert [a for a, _ in spans] == np.cumsum([0] + [n for _, n in spans])[:-1].tolist()
        assert total == 2048 or total & (total - 1) == 0
    in_combos = sum(layout.taken.values()) / sum(n for s, n in count.items() if s % 32 == 0 and s < 2048)
    assert in_combos > 0.8  # the rest has no partner left


def test_sharding(spark, odd, none):
    got = sharding.shard(odd, bucket_bytes=20_000).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in odd_rows())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1
    assert sharding.sharded(none).count() == 0
    hot = spark.range(3000).select((F.col("id") % 3).alias("doc_id"), F.lit("copy of one text").alias("text"))
    big = sharding.shard(hot, bucket_bytes=10_000)
    per = [r["count"] for r in big.groupBy("shard").count().collect()]
    assert per == [375] * 8
    first = [r.doc_id for r in big.where("shard = 0").orderBy("slot").collect()]
    assert first != sorted(first)


def test_mixing(spark, odd, none):
    got = mixing.mix(odd).collect()
    size = Counter()
    for r in odd_rows():
        size[r[2]] += len((r[1] or "").encode().split())
    total = sum(size.values())
    ranked = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(ranked)}
    target, capped = {}, set()
    while True:  # plain resharing until none is above its cap
        left = 1.5 * total - sum(2 * size[s] for s in capped)
        free = [s for s in size if s not in capped]
        target = {s: 2.0 * size[s] if s in capped else left * weight[s] / sum(weight[f] for f in free) for s in size}
        over = {s for s in free if target[s] > 2 * size[s]}
        if not over:
            break
        capped |= over
    taken = Counter()
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-4
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == int(round(target[s], 6)) for s in size)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(odd).collect()))
    assert mixing.mix(none).count() == 0
