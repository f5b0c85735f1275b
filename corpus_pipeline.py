"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared scratch folder and reads it again as the next
stage's documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import jaccard_join, line_dedup, mixing, packing, toxicity
from recspark.llm.common import documents, fresh, numbered, written
from recspark.session import clean_scratch, scratch_count


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models reject go; a null or empty
    text is never rejected."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = fresh("_toxic", docs)
    return toxicity.score(docs, model, out=score).where(F.col(score) < 0.5).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-equal lines one stays; documents without any line
    left go; ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source by its target: a document comes as often as the mix takes
    it, the one on the cut if at least half of it is taken; a document without
    words weighs nothing and comes once."""
    rows, row = numbered(docs)
    taken = mixing.mix(rows.select("doc_id", "source", "text", F.col(row).alias("_row")), keep=("_row",))
    times = (F.when(F.col("size") == 0, 1)
             .otherwise(F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size")))).cast("int"))
    copies = taken.select(F.col("_row").alias(row), F.explode(F.array_repeat(F.lit(True), times)))
    return rows.join(copies.select(row), row).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# learned models and token ids have no SQL form; tests/llm holds a brute-force one
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage has written besides its output goes
    once that is written."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        mark = scratch_count(spark)
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        clean_scratch(spark, mark, keep="stage-")
    return docs
