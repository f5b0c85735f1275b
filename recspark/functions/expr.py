"""Column expressions (all JVM-side, codegen friendly; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.constants import MS_EPOCH_CUTOFF, RATING_LOG_PREFIX


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    """Java ``String.trim``: strip every char <= U+0020 at both ends."""
    return F.regexp_replace(_c(c), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def rating_log_payload(c, prefix: str = RATING_LOG_PREFIX) -> Column:
    """Text after the first prefix, up to a second prefix, trimmed.

    NULL when the line has no prefix or the payload is empty, so a filter on
    ``isNotNull`` drops both (the original throws on the latter).
    """
    c = _c(c)
    part = java_trim(F.get(F.split(c, r"\Q" + prefix + r"\E"), 1))
    return F.when(c.contains(prefix) & (F.length(part) > 0), part)


def filter_rating_logs(df: DataFrame, col: str = "value",
                       prefix: str = RATING_LOG_PREFIX) -> DataFrame:
    """Keep log lines with a rating payload; output one column ``value``."""
    return (df.select(rating_log_payload(col, prefix).alias("value"))
              .where(F.col("value").isNotNull()))


def parse_rating_fields(c) -> list[Column]:
    """``user|product|score|ts`` -> typed columns (NULL where malformed)."""
    parts = F.split(_c(c), r"\|")
    return [
        F.get(parts, 0).try_cast("int").alias("userId"),
        F.get(parts, 1).try_cast("int").alias("productId"),
        F.get(parts, 2).try_cast("double").alias("score"),
        normalize_ts(F.get(parts, 3).try_cast("bigint")).alias("ts"),
    ]


def parse_rating_events(df: DataFrame, col: str = "value",
                        with_rejects: bool = False):
    """Parse event text into (userId, productId, score, ts).

    Malformed rows (missing/non-numeric field) go to a reject frame instead of
    failing the task; ``with_rejects=True`` returns ``(good, rejects)``.
    """
    parsed = df.select(F.col(col).alias("_raw"), *parse_rating_fields(col))
    ok = (F.col("userId").isNotNull() & F.col("productId").isNotNull()
          & F.col("score").isNotNull() & F.col("ts").isNotNull())
    good = parsed.where(ok).drop("_raw")
    if not with_rejects:
        return good
    rejects = parsed.where(~ok).select(F.col("_raw").alias(col))
    return good, rejects


def rating_month(ts) -> Column:
    """Epoch seconds -> yyyyMM as int, in the session time zone (UTC)."""
    return F.date_format(F.timestamp_seconds(_c(ts)), "yyyyMM").cast("int")


def normalize_ts(ts) -> Column:
    """Epoch seconds or milliseconds -> seconds."""
    ts = _c(ts)
    return F.when(ts >= F.lit(MS_EPOCH_CUTOFF), F.floor(ts / 1000).cast("bigint")) \
            .otherwise(ts.cast("bigint"))


def normalize_score(raw) -> Column:
    """Star clicks 1..10 -> score 0.5..5.0 (2 decimals, half up)."""
    return F.round(_c(raw).cast("double") / 2.0, 2)


def user_id_from_name(name) -> Column:
    """32-bit Java ``String.hashCode`` of a name, as a native expression.

    Code points above U+FFFF are expanded to their two UTF-16 units, since
    Java hashes UTF-16 units; the fold keeps the value mod 2^32 and maps it
    to a signed int at the end.
    """
    cps = F.transform(F.split(_c(name), ""), lambda ch: F.ascii(ch).cast("bigint"))
    units = F.flatten(F.transform(cps, lambda cp: F.when(
        cp > 65535,
        F.array(F.lit(0xD800) + F.shiftright(cp - 0x10000, 10),
                F.lit(0xDC00) + ((cp - 0x10000).bitwiseAND(F.lit(0x3FF))))
    ).otherwise(F.array(cp))))
    h = F.aggregate(units, F.lit(0).cast("bigint"),
                    lambda acc, u: F.pmod(acc * 31 + u, F.lit(4294967296)))
    return F.when(h >= 2147483648, h - 4294967296).otherwise(h).cast("int")


def split_tags(df: DataFrame, col: str = "tags", out: str = "tag") -> DataFrame:
    """``a|b|c`` -> one row per tag (other columns kept, empty tags dropped)."""
    return (df.withColumn(out, F.explode(F.split(F.col(col), r"\|")))
              .where(F.length(out) > 0))


def format_rating_event(userId="userId", productId="productId", score="score",
                        ts="ts", prefix: str = RATING_LOG_PREFIX) -> Column:
    """Rating -> ``PREFIX:user|product|score|ts`` log payload."""
    # a NULL field stays an empty field, so the others keep their places
    return F.concat(F.lit(prefix), F.concat_ws("|", *[
        F.coalesce(_c(c).cast("string"), F.lit("")) for c in (userId, productId, score, ts)]))


def register_sql_functions(spark: SparkSession) -> None:
    """SQL names for the expressions above (SQL-bodied, no Python)."""
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION changeDate(x BIGINT)
                 RETURNS INT
                 RETURN CAST(date_format(timestamp_seconds(x), 'yyyyMM') AS INT)""")
