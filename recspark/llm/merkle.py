"""Merkle manifest of a table: per-language trees, one root, a proof per row.

A row's leaf is the hash H of its five columns; inside a language the leaves
ascend by doc_id, every two neighbours hash to their parent (a last lone one on
its own), and what remains is the language's subroot.  The subroots, ordered by
language, form the same kind of tree, whose top is the root.

* **Places.**  One range partitioning over (language, doc_id) and the counts of
  the partitions before give every leaf its place, so a language with a third
  of all rows spreads over many tasks.
* **Hashing.**  Aligned blocks of 2^``BLOCK`` nodes hash ``BLOCK`` levels in one
  task; the tops of the blocks are the next round's leaves.
* **Proofs by pointer jumping.**  A node holds the segment of siblings on its
  way to an ancestor, at first its parent.  Each round joins the nodes with
  themselves: a node takes over its ancestor's segment, which doubles the
  distance, until every leaf has reached the top.  After a round only nodes on
  levels that a later jump can start from or land on are kept.  2^d nodes share
  an ancestor at distance d: past 2^``SPLIT`` of them the ancestor is copied
  once for every block of 2^``SPLIT``, so no join key holds more rows than that.

A proof is the concatenation of raw 32-byte sibling digests, left out where a
node has none; sides follow from a leaf's place and the number of leaves.

Edge cases: a null column hashes as ``-``; null languages form one tree and
come first; rows that share language and doc_id are ordered by leaf (equal rows
are interchangeable); a null doc_id comes first; a lone leaf is its subroot, a
lone subroot the root, and the proof is then empty; an empty table gives no
rows; other columns are ignored; texts are hashed whole.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recspark.llm.common import cut, written

BLOCK = 10
SPLIT = 8
MOST_GROUPS = 100_000  # of the group table's rows, to broadcast it (some 20 MB)
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(**changed: F.Column) -> F.Column:
    """H of a row's columns; ``changed`` replaces some of them."""
    parts = []
    for name in COLUMNS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, the place from 0 within the group, and ``n``, the
    group's rows; rows equal in ``order`` and ``place`` must not exist."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], "place"]
    dealt = written(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                    .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()),
                    "placed")
    before = W.partitionBy(group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    runs = (dealt.groupBy(group, "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
            .withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
            .withColumn("n", F.sum("rows").over(W.partitionBy(group)))
            .withColumnRenamed(group, "run_group").withColumnRenamed("part", "run_part"))
    return (dealt.join(runs, (F.col("part") == F.col("run_part")) & F.col(group).eqNullSafe(F.col("run_group")))
            .withColumn("idx", F.col("before") + F.col("at") - F.col("first"))
            .drop("run_group", "run_part", "part", "at", "first", "before", "rows", "place"))


def _parent(run: list[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in run).encode()).digest()


def _hash_block(block: int):
    """All nodes of an aligned block below its top, with their siblings; and
    the top (or the tree's root, if it comes earlier) with its digest."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        g, n, level, first = (int(pdf[c].iloc[0]) for c in ("g", "n", "level", "idx"))
        nodes, out = list(pdf["digest"]), []
        for h in range(level, level + block):
            if (n - 1) >> h == 0:
                break
            for i in range(len(nodes)):
                out.append((g, n, h, first + i, nodes[i ^ 1] if i ^ 1 < len(nodes) else None, None))
            nodes, first, level = [_parent(nodes[i:i + 2]) for i in range(0, len(nodes), 2)], first >> 1, h + 1
        out.append((g, n, level, first, None, nodes[0]))
        return pd.DataFrame(out, columns=["g", "n", "level", "idx", "sibling", "digest"])
    return run


def tree(leaves: DataFrame, most: int, block: int = BLOCK, split: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """(g, n, idx, digest) leaves, at most ``most`` in a group, to the roots
    (g, n, digest) and the proofs (g, idx, siblings) of all leaves of groups
    with several."""
    depth = (most - 1).bit_length()
    level, now, nodes, roots = 0, leaves.withColumn("level", F.lit(0)), [], []
    while True:
        hashed = written(
            now.withColumn("block", F.shiftright("idx", block)).groupBy("g", "block").applyInPandas(
                _hash_block(block), "g long, n long, level int, idx long, sibling binary, digest binary"), "hashed")
        nodes.append(hashed.where("digest IS NULL"))
        tops = hashed.where("digest IS NOT NULL")
        done = F.expr("shiftright(n - 1, level) = 0")
        roots.append(tops.where(done))
        level += block
        if level >= depth:
            break
        now = tops.where(~done).drop("sibling")
    every = nodes[0]
    for more in nodes[1:]:
        every = every.union(more)
    state = every.select("g", "n", "level", "idx", F.coalesce("sibling", F.lit(b"")).alias("siblings"))
    top = roots[0]
    for more in roots[1:]:
        top = top.union(more)
    return top.select("g", "n", "digest"), _jump(state, depth, split)


def _jump(state: DataFrame, depth: int, split: int) -> DataFrame:
    """Pointer jumping over (g, n, level, idx, siblings) segments to one parent."""
    distance = 1
    while distance < depth:
        copies = max(0, distance - split)
        low = (state.where(F.col("level") % (2 * distance) == 0)
               .withColumn("up", F.col("level") + distance)
               .withColumn("block", F.shiftright("idx", min(distance, split))))
        last = F.expr(f"least(shiftleft(idx + 1, {copies}), shiftright(n - 1, level - {copies}) + 1) - 1")
        high = (state.where(F.col("level") % (2 * distance) == distance)
                .select("g", F.col("level").alias("up"), F.col("siblings").alias("more"),
                        F.explode(F.sequence(F.expr(f"shiftleft(idx, {copies})"), last)).alias("block")))
        state = written(low.join(high, ["g", "up", "block"], "left").select(
            "g", "n", "level", "idx",
            F.concat("siblings", F.coalesce("more", F.lit(b""))).alias("siblings")), "jumped")
        distance *= 2
    return state.where("level = 0").select("g", "idx", "siblings")


def fold(digest: bytes, idx: int, n: int, siblings: bytes, at: int = 0) -> tuple[bytes, int]:
    """The top of a tree of ``n`` leaves from a leaf at ``idx`` and its proof
    from byte ``at`` on, and the byte after it."""
    while n > 1:
        if idx ^ 1 < n:
            other, at = siblings[at:at + 32], at + 32
            digest = _parent([other, digest] if idx & 1 else [digest, other])
        else:
            digest = _parent([digest])
        idx, n = idx >> 1, (n + 1) >> 1
    return digest, at


def _folded(batches):
    for b in batches:
        cols = [b.column(b.schema.get_field_index(c)).to_pylist()
                for c in ("presented", "idx", "n", "lang_idx", "langs", "siblings")]
        tops = []
        for digest, idx, n, lang_idx, langs, siblings in zip(*cols):
            sub, at = fold(digest, idx, n, siblings)
            tops.append(fold(sub, lang_idx, langs, siblings, at)[0])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tops, pa.binary())], names=[*b.schema.names, "folded"])


def manifest(docs: DataFrame, presented: F.Column | None = None, block: int = BLOCK, split: int = SPLIT) -> DataFrame:
    """doc_id, lang, idx, n (place among the language's rows), lang_idx, langs,
    leaf, subroot, root, siblings (the proof) and ``presented`` (another leaf
    to verify against the proof; the leaf itself unless given), digests binary."""
    rows = cut(docs.select(
        *COLUMNS).select("doc_id", "lang", leaf_hash().alias("leaf"),
                         (presented if presented is not None else F.lit(None).cast("binary")).alias("presented"),
                         F.monotonically_increasing_id().alias("place")))
    leaves = written(placed(rows, "lang", ["doc_id", "leaf"]), "leaves")
    counts = leaves.groupBy("lang").agg(F.max("n").alias("lang_n"))
    langs = cut(placed(counts.withColumn("place", F.lit(0)).withColumn("g", F.lit(0)), "g", ["lang"])
                .select("lang", "lang_n", F.col("idx").alias("lang_idx"), F.col("n").alias("langs")))
    many, most = langs.agg(F.count("*"), F.max("lang_n")).first()
    if not many:
        return rows.select("doc_id", "lang", *[F.lit(0).cast("long").alias(c) for c in ("idx", "n", "lang_idx", "langs")],
                           "leaf", *[F.col("leaf").alias(c) for c in ("subroot", "root", "siblings", "presented")])
    side = F.broadcast if many <= MOST_GROUPS else (lambda table: table)
    named = langs.select(F.col("lang").alias("named"), "lang_idx")
    leaves = leaves.join(side(named), F.col("lang").eqNullSafe(F.col("named"))).drop("named")
    subroots, proofs = tree(leaves.select(F.col("lang_idx").alias("g"), "n", "idx", F.col("leaf").alias("digest")),
                            most, block, split)
    subroots = cut(subroots.select(F.col("g").alias("lang_idx"), F.col("digest").alias("subroot")))
    roots, above = tree(subroots.select(F.lit(0).cast("long").alias("g"), F.lit(many).cast("long").alias("n"),
                                        F.col("lang_idx").alias("idx"), F.col("subroot").alias("digest")),
                        many, block, split)
    root = bytes(roots.first()["digest"])
    tops = cut(subroots.join(above.select(F.col("idx").alias("lang_idx"), F.col("siblings").alias("above")), "lang_idx", "left"))
    return (leaves.join(proofs.withColumnRenamed("g", "lang_idx"), ["lang_idx", "idx"], "left")
            .join(side(tops), "lang_idx")
            .select("doc_id", "lang", "idx", "n", "lang_idx", F.lit(many).cast("long").alias("langs"), "leaf", "subroot",
                    F.lit(root).alias("root"),
                    F.concat(F.coalesce("siblings", F.lit(b"")), F.coalesce("above", F.lit(b""))).alias("siblings"),
                    F.coalesce("presented", "leaf").alias("presented")))


def verified(listed: DataFrame) -> DataFrame:
    """``manifest`` rows with ``folded``, the root that ``presented`` and the
    proof give, and ``verified``, whether it is the root."""
    schema = listed.schema.simpleString()[len("struct<"):-1]
    return (listed.mapInArrow(_folded, f"{schema},folded:binary")
            .withColumn("verified", F.col("folded") == F.col("root")))


def tampered(every: int = 7) -> F.Column:
    """Leaf of a row whose n_chars grew by 1, where ``every`` divides the crc32
    of its doc_id; null elsewhere, and where n_chars is null."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    longer = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    return F.when(hit & F.col("n_chars").isNotNull(), leaf_hash(n_chars=longer))


# crc32 bit by bit: a byte is mixed in, then eight shifts (-1)
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang,
    [coalesce(strlen(v::VARCHAR)::VARCHAR || ':' || v::VARCHAR, '-') FOR v IN [doc_id::VARCHAR, source, lang]] AS a,
    n_chars, coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS t,
    list_reduce(flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(doc_id::VARCHAR, '')]),
      lambda x, y: CASE WHEN y >= 0 THEN xor(x, y::BIGINT) ELSE xor(x >> 1, 3988292384 * (x & 1)) END,
      4294967295::BIGINT) AS c FROM documents),
e AS (SELECT doc_id, lang, sha256(a[1] || a[2] || a[3] || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars, '-') || t) AS leaf,
        CASE WHEN xor(c, 4294967295) % 7 = 0 AND n_chars IS NOT NULL
          THEN sha256(a[1] || a[2] || a[3] || strlen((n_chars + 1)::VARCHAR)::VARCHAR || ':' || (n_chars + 1) || t) END AS bad
      FROM d),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS id FROM e),
tree(lang, level, i, n, h) AS (
  SELECT lang, 0, i, n, leaf FROM l
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1
  GROUP BY lang, level, i // 2, n),
g AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
top(level, i, n, h) AS (
  SELECT 0, i, n, subroot FROM g
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 2, n),
way(id, top, level, i, n, h, sib, seen) AS (
  SELECT id, false, 0, i, n, coalesce(bad, leaf), NULL::VARCHAR, '' FROM l
  UNION ALL
  SELECT way.id, way.top OR way.n = 1, CASE WHEN way.n = 1 THEN 0 ELSE way.level + 1 END,
    CASE WHEN way.n = 1 THEN g.i ELSE way.i // 2 END, CASE WHEN way.n = 1 THEN g.n ELSE (way.n + 1) // 2 END,
    CASE WHEN way.n = 1 THEN way.h
         WHEN way.i % 2 = 0 THEN sha256(way.h || coalesce(s.h, u.h, '')) ELSE sha256(coalesce(s.h, u.h) || way.h) END,
    coalesce(s.h, u.h), way.seen || CASE WHEN way.n = 1 THEN '' ELSE coalesce(s.h, u.h, '') END
  FROM way JOIN l USING (id) JOIN g ON g.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN tree s ON NOT way.top AND way.n > 1 AND s.lang IS NOT DISTINCT FROM l.lang AND s.level = way.level AND s.i = xor(way.i, 1)
  LEFT JOIN top u ON way.top AND u.level = way.level AND u.i = xor(way.i, 1)
  WHERE NOT way.top OR way.n > 1)
SELECT l.doc_id, l.leaf, g.subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(way.seen) AS proof_sha256,
  way.h AS folded_root, way.h = (SELECT h FROM top WHERE n = 1) AS verified
FROM l JOIN g ON g.lang IS NOT DISTINCT FROM l.lang JOIN way ON way.id = l.id AND way.top AND way.n = 1
"""
