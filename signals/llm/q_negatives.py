"""op12: hard negatives of every anchor and positive among the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.llm.multi_index import cleaned, hard_negatives
from signals.llm.registry import register

_SQL = """
WITH rows AS (
    SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda v: floor(256 * CAST(v AS DOUBLE))) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0
),
scores AS (
    SELECT a.k AS a, a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
    FROM rows a JOIN rows r ON a.k <> r.k WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT a, anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS FIRST) <= 5
),
placed AS (
    SELECT p.anchor_id, p.positive_id,
        row_number() OVER (PARTITION BY p.a, p.positive_id ORDER BY s.score DESC, s.vec_id NULLS FIRST) AS rank,
        s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positives p JOIN scores s ON s.a = p.a
    WHERE NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM placed WHERE rank <= 10
"""


@register("op12_negatives", _SQL)
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    moved = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(cleaned(vectors, moved), F.col("vec_id") % 100 == 0)
