"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.session import checkpoint_dir, scratch_path

# words are runs of characters other than blank, \t \n \v \f \r; bytes.split()
# splits UTF-8 bytes at exactly these six
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 2 << 20
# what a Python worker holds from task to task, by kind of task; a task of another kind lets it go
HELD: dict[str, dict] = {}
FILTER = 26          # log2 of the most bits of a filter


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared scratch folder and read again, so
    a lost executor never makes the plan above run twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a narrow table in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fresh(name: str, df: DataFrame) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with their place in the table, written down so that it never
    changes, and the name of that column (not one of the input's)."""
    row = fresh("_row", docs)
    return written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text",
                  limit: int = BATCH_BYTES, held: str | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with at most about ``limit`` bytes in a string
    column (one row at least), so that a task's Python memory follows the
    longest text, not the batch.  Workers serve many stages: all but what is
    ``held`` for this kind of task goes first."""
    for kind in set(HELD) - {held}:
        HELD.pop(kind).clear()
    for b in batches:
        if not b.num_rows:
            continue
        col = b.column(b.schema.get_field_index(column))
        size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64)
        at = np.concatenate([[0], np.cumsum(size + 64)])
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
            yield b.slice(lo, hi - lo)
            lo = hi


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null reads as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values over the whole range."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def maybe(rows: DataFrame, wanted: DataFrame, *keys: str, least: int = 24) -> DataFrame:
    """Without most of the rows whose keys are not in ``wanted``, so that they
    needn't be shuffled for the join that decides (an inner one: a semi join
    would be planned below this): a filter of about 8 bits a key, 2 **
    ``least`` at least and 2 ** ``FILTER`` at most, which is broadcast."""
    size = 1 << min(max((8 * wanted.count()).bit_length(), least), FILTER)
    place = F.pmod(F.xxhash64(*keys), F.lit(size))
    word, bit = (place / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    filled = wanted.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return (rows.withColumn("_word", word).join(F.broadcast(filled), "_word")
            .where(F.col("_bits").bitwiseAND(bit) != 0).drop("_word", "_bits"))


def same(a, b):
    """Null-safe equality of two columns."""
    return F.col(a).eqNullSafe(F.col(b)) if isinstance(a, str) else a.eqNullSafe(b)
