"""Queries on ``embeddings`` with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.llm import codes, negatives
from mediamart.llm.common import table


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, books = codes.compress(vectors)
    return codes.group_errors(coded, "label").select(
        "vec_id", "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256")
    )


def _op11_sql(rounds: int = 6) -> str:
    """The same by comparing every part with every entry; one pair of relations per round."""

    def nearest(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (
  SELECT vec_id, label, part, v, best % 16 AS entry, best // 16 AS error
  FROM (SELECT p.vec_id, p.label, p.part, any_value(p.v) AS v,
               min(CAST(list_sum(list_transform(list_zip(p.v, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * 16 + c.entry) AS best
        FROM parts p JOIN c{k} c USING (part) GROUP BY ALL)
)"""

    def books(k: int) -> str:
        return f"""c{k} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.e, c.e) AS e
  FROM c{k - 1} c LEFT JOIN (
    SELECT part, entry, list(x ORDER BY i) AS e
    FROM (SELECT part, entry, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS x
          FROM a{k - 1}, (SELECT unnest(range(1, 1 + (SELECT max(len(v)) FROM parts))) AS i) GROUP BY ALL)
    GROUP BY ALL) m USING (part, entry)
)"""

    steps = ",\n".join(f"{nearest(k)},\n{books(k + 1)}" for k in range(rounds))
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, part, v[part * (len(v) // 8) + 1 : (part + 1) * (len(v) // 8)] AS v
  FROM kept, (SELECT unnest(range(8)) AS part)
), c0 AS MATERIALIZED (
  SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, v AS e
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)
),
{steps},
{nearest(rounds)},
final AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error
  FROM a{rounds} GROUP BY ALL
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM final
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0, label)


OP13_SQL = """
WITH known AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM known a, known r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scored s USING (anchor_id)
WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""

QUERIES = {"op11_vector_codes": op11_vector_codes, "op13_hard_negatives": op13_hard_negatives}
ORACLES = {"op11_vector_codes": _op11_sql(), "op13_hard_negatives": OP13_SQL}
