"""License scan: exact set-similarity join of text blocks with templates.

Templates are license sentences.  The blocks of a text for a template T are its
windows of ``|T| / 0.8`` consecutive words (rounded up; the whole text, if it is
shorter), one at every word and across line breaks, so that a sentence is found
however it is wrapped, and words scattered over a page are not a sentence.  A
block matches when it holds at least ``PERCENT`` of T's distinct words
(containment).  The join is exact and filtered:

* Global frequency order: one pass counts how many texts of the corpus hold each
  template word; a template's words are sorted from rare to frequent.  (The
  vocabulary counted is that of the templates, so these counts are bounded.)
* Prefix filter: a match misses at most ``size - need`` words, so it holds one
  of T's ``size - need + 1`` rarest words; an index from those words to
  templates yields the candidates of a text, and only windows around a prefix
  word are looked at.
* Length filter: a text with fewer than ``need`` distinct words is out, and so is
  a stretch around a prefix word with fewer than ``need`` of T's words.
* Positional filter: T's words are read in order of rarity; a text is given up as
  soon as the words that are left can't reach ``need``.

Base labels: phrases whose words stand consecutively anywhere in a text (line
breaks don't matter).  Words are runs of digits, letters a-z and characters
beyond ASCII, after lower-casing A-Z.

Edge cases: null or empty texts have no words, no labels, score 0; repeated
rows and null doc_ids are scanned like any others; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.common import small_batches, texts

PERCENT = 80
PHRASES = {  # base labels: fixed values
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
TEMPLATES = {  # sentences by which licenses are named or granted
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "you may not use this file except in compliance with the license": "apache-2",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it": "gpl-3",
    "this work is licensed under a creative commons attribution noncommercial license": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "all rights reserved": "all-rights-reserved",
}
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def _words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def word_frequencies(docs: DataFrame, templates: dict[str, str]) -> dict[bytes, int]:
    """Texts of the corpus that hold each template word."""
    vocabulary = sorted({w for t in templates for w in t.encode().split()})
    at = {w: i for i, w in enumerate(vocabulary)}
    known = set(vocabulary)

    def run(batches):
        count = np.zeros(len(vocabulary), np.int64)
        for b in small_batches(batches):
            for t in texts(b):
                for w in known.intersection(_words(t.encode("utf-8", "replace"))):
                    count[at[w]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(count))), pa.array(count)], names=["w", "n"])

    rows = docs.select("text").mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    return {w: 0 for w in vocabulary} | {vocabulary[r["w"]]: r["n"] for r in rows}


def window(template: str, percent: int = PERCENT) -> int:
    """Words of a block for a template."""
    return -(-100 * len(template.split()) // percent)


class Index:
    """Templates by the words of their prefixes."""

    def __init__(self, templates: dict[str, str], frequency: dict[bytes, int], percent: int = PERCENT):
        self.rows, self.by_word = [], {}
        for t, label in templates.items():
            words = sorted(set(t.encode().split()), key=lambda w: (frequency[w], w))
            need = -(-percent * len(words) // 100)
            prefix = words[:len(words) - need + 1]
            self.rows.append((words, frozenset(prefix), need, window(t, percent), label))
            for w in prefix:
                self.by_word.setdefault(w, []).append(len(self.rows) - 1)
        self.prefixes = set(self.by_word)
        self.shortest = min(need for _, _, need, _, _ in self.rows)

    def match(self, words: list[bytes]) -> list[tuple[str, int, int]]:
        """(label, most words held by a block, words of the template) of each
        template that a text matches."""
        out, held = [], set(words)
        if len(held) < self.shortest:
            return out
        for i in {i for w in self.prefixes.intersection(held) for i in self.by_word[w]}:
            template, prefix, need, size, label = self.rows[i]
            some = 0
            for at, w in enumerate(template):
                some += w in held
                if some + len(template) - at - 1 < need:
                    break
            else:
                own = frozenset(template)
                hits = [(at, w) for at, w in enumerate(words) if w in own]
                best = max((_densest(x, size) for x in _stretches(hits, prefix, size) if len(x) >= need), default=0)
                if best >= need:
                    out.append((label, best, len(template)))
        return out


def _stretches(hits: list[tuple[int, bytes]], prefix: frozenset, size: int):
    """The runs of a template's words within a window of a prefix word."""
    near, run, end = [at for at, w in hits if w in prefix], [], -1
    k = 0
    for at, w in hits:
        while k < len(near) and near[k] <= at - size:
            k += 1
        if k < len(near) and near[k] < at + size:
            if run and at >= run[-1][0] + size:  # no window holds both
                yield run
                run = []
            run.append((at, w))
    if run:
        yield run


def _densest(hits: list[tuple[int, bytes]], size: int) -> int:
    """The most distinct words that a window of ``size`` places holds."""
    held, lo, best = Counter(), 0, 0
    for at, w in hits:
        held[w] += 1
        while hits[lo][0] <= at - size:
            old = hits[lo][1]
            held[old] -= 1
            if not held[old]:
                del held[old]
            lo += 1
        best = max(best, len(held))
    return best


def scan(text: str, index: Index) -> tuple:
    """Words, base places with their first and last word, labels and score."""
    raw = text.encode("utf-8", "replace")
    words = _words(raw)
    joined = b" " + b" ".join(words) + b" "
    places, base = [], set()
    for phrase, label in PHRASES.items():
        p = b" " + phrase.encode() + b" "
        at = joined.find(p)
        while at >= 0:
            places.append(joined.count(b" ", 0, at + 1) - 1)
            base.add(label)
            at = joined.find(p, at + 1)
    labels, score = set(base), 0.0
    for label, held, size in index.match(words):
        labels.add(label)
        score = max(score, held / size)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if base else score)


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """Base places, labels and score of every row."""
    index = Index(templates, word_frequencies(docs, templates), percent)

    def run(batches):
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        for b in small_batches(batches):
            cols = zip(*(scan(t, index) for t in texts(b)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0)] + [pa.array(c, t) for c, t in zip(cols, types)],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
             "base_labels string, labels string, score double")


def sql(templates: dict[str, str] = TEMPLATES, percent: int = PERCENT) -> str:
    """The same by plain containment over all windows and templates."""
    t = ", ".join(f"('{k}', '{v}', {window(k, percent)})" for k, v in templates.items())
    p = ", ".join(f"('{k}', '{v}')" for k, v in PHRASES.items())
    words = (r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {words.format("coalesce(text, '')")} AS w FROM documents),
t(s, label, size) AS (VALUES {t}), p(s, label) AS (VALUES {p}),
tw AS (SELECT list_distinct(string_split(s, ' ')) AS tw, label, size AS block, s FROM t),
i AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d),
x AS (SELECT s, unnest(tw) AS word, label, block, len(tw) AS size FROM tw),
m AS (SELECT doc_id, label, size, count(DISTINCT word) OVER (
        PARTITION BY doc_id, s ORDER BY i.i RANGE BETWEEN CURRENT ROW AND (block - 1) FOLLOWING) AS held
      FROM i JOIN x ON x.word = i.w[i.i + 1]),
mm AS (SELECT doc_id, label, held / size AS score FROM m WHERE 100 * held >= {percent} * size),
h AS (SELECT i.doc_id, i.i, p.label FROM i JOIN p ON array_to_string(w[i.i + 1:i.i + len(string_split(p.s, ' '))], ' ') = p.s),
hb AS (SELECT doc_id, count(*) AS n, min(i) AS f, max(i) AS l, string_agg(DISTINCT label, ',' ORDER BY label) AS bl FROM h GROUP BY 1),
a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS al FROM
      (SELECT doc_id, label FROM mm UNION SELECT doc_id, label FROM h) GROUP BY 1),
s AS (SELECT doc_id, max(score) AS score FROM mm GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, f::BIGINT AS first_word, l::BIGINT AS last_word,
  coalesce(bl, '') AS base_labels, coalesce(al, '') AS labels,
  CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0)::DOUBLE END AS score
FROM d LEFT JOIN hb USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN s USING (doc_id)
"""
