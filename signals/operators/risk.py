"""Risk scores and the ranking query."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signals.session import small_table

# Fixed values (ours; the reference declares no weights): weight per severity.
# Severity is either a priority 0-3 or an alert level Info/Minor/Major/Critical.
DEFAULT_WEIGHTS = {
    "0": 1.0, "1": 5.0, "2": 15.0, "3": 40.0,
    "Info": 1.0, "Minor": 5.0, "Major": 15.0, "Critical": 40.0,
}
MAX_SCORE = 100.0


def weights_table(spark: SparkSession, weights: Mapping[str, float] | None = None) -> DataFrame:
    """(severity, weight) dimension table; its size is the mapping's size."""
    w = weights or DEFAULT_WEIGHTS
    return small_table(spark, [(k, float(v)) for k, v in w.items()], "severity string, weight double")


#: Weights are summed exactly, so a score doesn't depend on the order of its rows.
EXACT = "decimal(28,6)"


def risk_scores(
    detections: DataFrame,
    weights: DataFrame | Mapping[str, float] | None = None,
    key: Sequence[str] = ("tenant_id", "entity"),
    severity_col: str = "severity",
    max_score: float = MAX_SCORE,
) -> DataFrame:
    """Per (tenant, entity): ``score`` = least(max, sum of severity weights) (F8).

    Adds ``n_detections`` and ``rank`` (dense rank of the score within the
    tenant, 1 = riskiest). Weights count to six decimals and are summed
    exactly. The rank does not sort a tenant's entities in one task: the
    distinct scores of a tenant (few, scores are capped) are ranked and joined
    back; both sides read one aggregation.
    No decay over time is applied.
    """
    key = list(key)
    if weights is None or isinstance(weights, Mapping):
        weights = weights_table(detections.sparkSession, weights)
    w = weights.select(F.col("severity").alias("__sev"), F.col("weight").cast(EXACT).alias("__w"))
    d = detections.join(w, F.col(severity_col).cast("string") == F.col("__sev"), "left")
    scores = d.groupBy(*key).agg(
        F.least(F.lit(str(max_score)).cast(EXACT), F.coalesce(F.sum("__w").cast(EXACT), F.lit("0").cast(EXACT))).alias("score"),
        F.count(F.lit(1)).alias("n_detections"),
    )
    tenant = key[:-1]
    # the count is carried along so that both sides have the same columns and share the exchange
    distinct_scores = scores.groupBy(*tenant, "score").agg(F.max("n_detections").alias("__most"))
    rank_w = Window.partitionBy(*tenant).orderBy(F.col("score").desc()) if tenant else Window.orderBy(F.col("score").desc())
    ranks = distinct_scores.withColumn("rank", F.dense_rank().over(rank_w).cast("bigint"))
    ranks = ranks.select(*[F.col(t).alias(f"__r_{t}") for t in tenant], F.col("score").alias("__r_score"), "rank", "__most")
    cond = (scores["score"] == ranks["__r_score"]) & (scores["n_detections"] <= ranks["__most"])
    for t in tenant:
        cond = cond & scores[t].eqNullSafe(ranks[f"__r_{t}"])
    ranked = scores.join(ranks, cond).drop(*[f"__r_{t}" for t in tenant], "__r_score", "__most")
    return ranked.withColumn("score", F.col("score").cast("double"))


def top_risks(scores: DataFrame, tenant_id: str, k: int = 10, entity_col: str = "entity") -> DataFrame:
    """One tenant's scores, highest first, top ``k`` (ties by entity)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    return (
        scores.filter(F.col("tenant_id") == F.lit(tenant_id))
        .orderBy(F.col("score").desc(), F.col(entity_col))
        .limit(k)
    )
