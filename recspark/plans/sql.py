"""DuckDB SQL twins of the driver-table mapping and of every registered query.

These are the correctness oracles: independent, plain SQL over the driver's
parquet views, written from the definitions (not generated from the Spark
plans).  Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from recspark.constants import RATING_LOG_PREFIX

RATINGS = """
  SELECT CAST(o_custkey AS INTEGER) AS userId, CAST(l_partkey AS INTEGER) AS productId,
         round((1 + CAST(trunc(l_quantity) AS INTEGER) % 10) / 2.0, 2) AS score,
         CAST(floor(epoch(l_shipdate)) AS BIGINT) AS ts,
         l_shipdate AS o1, l_orderkey AS o2, l_linenumber AS o3, l_partkey AS o4, l_quantity AS o5
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

EVENT_RATINGS = """
  SELECT CAST(user_id AS INTEGER) AS userId, CAST(event_id % 500 AS INTEGER) AS productId,
         round((1 + event_id % 10) / 2.0, 2) AS score, CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         ts AS ts_full, event_id, event_type
  FROM events"""

VECTORS = """
  SELECT CAST(vec_id AS INTEGER) AS productId, CAST(embedding AS DOUBLE[]) AS vector
  FROM embeddings"""

PRODUCTS = """
  SELECT CAST(p_partkey AS INTEGER) AS productId, p_name AS name,
         'https://img.example/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS imageUrl,
         p_type || '|' || p_brand AS categories,
         replace(p_name, ' ', '|') || '|' || p_brand || '|' || replace(p_type, ' ', '|')
           || '|size' || CAST(p_size AS VARCHAR) AS tags
  FROM part"""

USERS = "SELECT CAST(c_custkey AS INTEGER) AS userId, c_name AS username FROM customer"

# purchase / click events carry the rating payload
LOG_LINES = f"""
  SELECT '2024-01-01 INFO --- [http-nio-8088-exec-' || CAST(event_id % 10 AS VARCHAR)
         || '] ratings.api(line: 123) : '
         || CASE WHEN event_type IN ('purchase', 'click')
                 THEN '{RATING_LOG_PREFIX}' || CAST(userId AS VARCHAR) || '|' || CAST(productId AS VARCHAR)
                      || '|' || CAST(score AS VARCHAR) || '|' || CAST(ts AS VARCHAR)
                 ELSE 'event ' || event_type || ' user ' || CAST(userId AS VARCHAR) END AS value,
         event_id, event_type, userId, productId, score, ts, ts_full
  FROM ({EVENT_RATINGS})"""

LOGGED_RATINGS = f"SELECT * FROM ({EVENT_RATINGS}) WHERE event_type IN ('purchase', 'click')"

AVERAGES = f"SELECT productId, avg(score) AS avg FROM ({RATINGS}) GROUP BY productId"


def sims(min_sim: float) -> str:
    """Ordered cosine pairs of the vectors, strictly above min_sim."""
    return f"""
  SELECT a.productId, b.productId AS simProductId,
         list_dot_product(a.vector, b.vector) / (a.nrm * b.nrm) AS sim
  FROM (SELECT productId, vector, sqrt(list_dot_product(vector, vector)) AS nrm FROM ({VECTORS})) a
  JOIN (SELECT productId, vector, sqrt(list_dot_product(vector, vector)) AS nrm FROM ({VECTORS})) b
    ON a.productId <> b.productId
  WHERE a.nrm > 0 AND b.nrm > 0
    AND list_dot_product(a.vector, b.vector) / (a.nrm * b.nrm) > {min_sim}"""


def online(events_sql: str, order: str, sim_floor: float = 0.2, score_floor: float = 0.1,
           recent_n: int = 21, k: int = 20,
           history_sql: str | None = None) -> dict[str, str]:
    """CTE bodies of the online recommender as of each user's newest rating;
    ``history_sql``: ratings that count as rated besides the events."""
    ctes = {
        "er": events_sql,
        "sims": sims(sim_floor),
        "ordered": f"SELECT *, row_number() OVER (PARTITION BY userId ORDER BY {order}) AS rn FROM er",
        "recents": f"SELECT userId, rn AS rank, productId, score FROM ordered WHERE rn <= {recent_n}",
        "trig": "SELECT userId, productId FROM ordered WHERE rn = 1",
        "rated": "SELECT DISTINCT userId, productId FROM er"
                 + (f" UNION SELECT userId, productId FROM ({history_sql})" if history_sql else ""),
        "cand0": """SELECT t.userId, s.simProductId AS productId, s.sim FROM trig t
                    JOIN sims s ON s.productId = t.productId
                    WHERE NOT EXISTS (SELECT 1 FROM rated r WHERE r.userId = t.userId
                                      AND r.productId = s.simProductId)""",
        "cand": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY userId
                    ORDER BY round(sim, 9) DESC, productId) AS rank FROM cand0) WHERE rank <= {k}""",
        "pairs": f"""SELECT c.userId, c.productId AS candidate, r.score, s.sim FROM cand c
                     JOIN recents r ON r.userId = c.userId
                     JOIN sims s ON s.productId = c.productId AND s.simProductId = r.productId
                     WHERE s.sim > {score_floor}""",
        "agg": """SELECT userId, candidate AS productId,
                    avg(sim * score) + log10(greatest(count(*) FILTER (WHERE score > 3), 1))
                    - log10(greatest(count(*) FILTER (WHERE score <= 3), 1)) AS score
                  FROM pairs GROUP BY userId, candidate""",
        "scored": """SELECT userId, CAST(row_number() OVER (PARTITION BY userId
                       ORDER BY round(score, 9) DESC, productId) AS INTEGER) AS rank,
                     productId, score FROM agg""",
    }
    return ctes


def with_ctes(ctes: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body
