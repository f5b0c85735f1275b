"""Queries of the corpus operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import (bpe, collocations, jaccard_join, licenses, line_dedup, merkle, mixing, packing, quality,
                           sharding, token_files, topk, toxicity)
from recspark.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn=None, oracle: str | None = None):
    if fn is None:
        return lambda f: query(f, oracle)
    QUERIES[fn.__name__] = fn
    if oracle:
        ORACLES[fn.__name__] = oracle
    return fn


@query
def op1_quality(spark, sf_dir):
    return quality.quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


@query
def op2_token_files(spark, sf_dir):
    return token_files.token_files(documents(spark, sf_dir)).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op3_line_dedup(spark, sf_dir):
    return line_dedup.deduped(documents(spark, sf_dir)).select(
        "doc_id", "kept_lines", "lost_lines", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))


@query
def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@query
def op5_toxicity(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(documents(spark, sf_dir), labels).drop("text")


@query(oracle=licenses.sql())
def op6_licenses(spark, sf_dir):
    return licenses.license_scan(documents(spark, sf_dir))


@query(oracle=topk.SQL)
def op7_topk(spark, sf_dir):
    rows = topk.vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return topk.top_k(rows, F.col("vec_id") % 20 == 0)


@query(oracle=mixing.SQL)
def op8_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op10_sharding(spark, sf_dir):
    return sharding.sharded(documents(spark, sf_dir)).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op11_bpe(spark, sf_dir):
    return bpe.digests(bpe.encode(documents(spark, sf_dir)))


@query(oracle=merkle.SQL)
def op12_merkle(spark, sf_dir):
    listed = merkle.verified(merkle.manifest(documents(spark, sf_dir), presented=merkle.tampered()))
    digest = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "folded")}
    return listed.select(
        "doc_id", digest["leaf"].alias("leaf"), digest["subroot"].alias("subroot"), digest["root"].alias("root"),
        F.sha2(F.lower(F.hex("siblings")), 256).alias("proof_sha256"), digest["folded"].alias("folded_root"), "verified")


@query(oracle=collocations.SQL)
def op13_collocations(spark, sf_dir):
    return collocations.collocations(documents(spark, sf_dir))
