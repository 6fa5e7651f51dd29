"""Response assignment (F10): detections x policy -> action queue, plus the unmatched rest."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.session import small_table
from signals.streaming.time import bound_of, event_time_for

# Workflow and playbook names the response API lists.
WORKFLOWS = ("Block_IP", "Isolate_Host")
PLAYBOOKS = ("PaloAlto_Block_Rule", "Slack_Alert_Bot")


def policy_table(spark: SparkSession, policy: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """(rule, action) rows from rule -> action(s)."""
    rows = []
    for rule, acts in policy.items():
        for a in [acts] if isinstance(acts, str) else acts:
            rows.append((rule, a))
    return small_table(spark, rows, "rule string, action string")


def assign_responses(
    detections: DataFrame,
    policy: DataFrame,
    entity: Sequence[str] = ("tenant_id", "entity"),
    ts_col: str = "event_time",
    window: str = "1 day",
    id_col: str = "event_id",
    rule_col: str = "rule",
    watermark: str | None = "1 hour",
) -> tuple[DataFrame, DataFrame]:
    """Return (queue, unmatched).

    ``queue`` has one row per entity + action + window with
    ``n_detections`` and the first detection id. ``unmatched`` holds the
    detections whose rule has no policy (left anti join). On a stream the
    window carries a watermark.
    """
    ent = list(entity)
    pol = policy.select(F.col("rule").alias("__rule"), "action")
    matched = detections.join(pol, F.col(rule_col) == F.col("__rule"), "inner")
    matched, ts = event_time_for(matched, ts_col, watermark)
    queue = matched.groupBy(*ent, "action", F.window(ts, window).alias("w")).agg(
        F.count(F.lit(1)).alias("n_detections"), F.min(id_col).alias("first_event_id")
    )
    start = bound_of(F.col("w.start"), detections, ts_col, watermark)
    queue = queue.withColumn("window_start", start).drop("w")
    unmatched = detections.join(pol, F.col(rule_col) == F.col("__rule"), "left_anti")
    return queue, unmatched


def first_responses(
    detections: DataFrame,
    policy: DataFrame,
    entity: Sequence[str] = ("tenant_id", "entity"),
    ts_col: str = "event_time",
    window: str = "1 day",
    rule_col: str = "rule",
    watermark: str = "1 hour",
) -> DataFrame:
    """Streaming response queue that acts on the first detection (F10, low latency).

    Each (entity, action, window) is emitted once, as soon as its first
    detection arrives, instead of when the window closes. The window itself is
    among the keys, so their state lives until the watermark passes its end.
    Output: entity columns, ``action``, ``window_start``, the detection's id
    and time. Batch input gives the same keys as ``assign_responses``.
    """
    ent = list(entity)
    pol = policy.select(F.col("rule").alias("__rule"), "action")
    matched = detections.join(pol, F.col(rule_col) == F.col("__rule"), "inner").drop("__rule")
    matched, ts = event_time_for(matched, ts_col, watermark)
    first = matched.withColumn("__w", F.window(ts, window)).dropDuplicates([*ent, "action", "__w"])
    start = bound_of(F.col("__w.start"), detections, ts_col, watermark)
    return first.withColumn("window_start", start).drop("__w", f"__{ts_col}_ts")
