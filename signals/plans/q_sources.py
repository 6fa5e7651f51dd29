"""Queries for file sources, zones, metrics and the offset ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signals.operators.tenancy import TIER_MODULES, entitled, grants_table, tenants_table
from signals.plans.fixtures import RAW_LOGS_SQL, TENANT_SQL, raw_logs, with_views
from signals.plans.registry import register
from signals.session import path_exists, scratch_path
from signals.sources.files import read_logs, write_files
from signals.sources.ledger import offset_ledger
from signals.sources.metrics import read_training_metrics, write_training_metrics
from signals.sources.tail_source import read_log_tail
from signals.sources.zones import read_zone, write_zone

CHUNK = 1000


_LANDED: dict[tuple[str, str], str] = {}


def log_files(spark: SparkSession, sf_dir: str) -> str:
    """Land raw_logs as text files, one file per block of 1,000 event ids in id order.

    Landed once per session and input folder (like a landing directory that
    the readers then scan); later calls reuse the files while they exist.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    path = _LANDED.get(key)
    if path and path_exists(spark, path + "/_SUCCESS"):
        return path
    path = scratch_path(spark, "logfiles")
    rl = raw_logs(spark, sf_dir).select("raw_data", "event_id", F.floor(F.col("event_id") / CHUNK).alias("chunk"))
    write_files(rl, path, "chunk", ["event_id"])
    _LANDED[key] = path
    return path


@register(
    "a1_read_logs",
    with_views(
        "SELECT raw_data, row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) AS line_no FROM raw_logs",
        RAW_LOGS_SQL,
    ),
)
def a1_read_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_logs(spark, log_files(spark, sf_dir)).select("raw_data", "line_no")


@register(
    "a3_byte_offset",
    with_views(
        "SELECT raw_data, row_number() OVER w AS line_no, CAST(SUM(strlen(raw_data) + 1) OVER w AS BIGINT) AS \"offset\" FROM raw_logs "
        "WINDOW w AS (PARTITION BY event_id // 1000 ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        RAW_LOGS_SQL,
    ),
)
def a3_byte_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_logs(spark, log_files(spark, sf_dir)).select("raw_data", "line_no", "offset")


@register(
    "a6_tenant_zone",
    with_views(
        "SELECT tenant_id, source_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, COUNT(*) AS n FROM raw_logs "
        "WHERE tenant_id = 'acme' GROUP BY ALL",
        RAW_LOGS_SQL,
    ),
)
def a6_tenant_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land raw logs in the tenants' raw zone (by tenant and day), read one tenant back."""
    root = scratch_path(spark, "zones")
    write_zone(raw_logs(spark, sf_dir).select("tenant_id", "source_id", "ts", "raw_data"), root, "data/raw", date_col="ts")
    z = read_zone(spark, root, "data/raw", tenant_id="acme")
    return z.groupBy("tenant_id", "source_id", F.col("dt").cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("n"))


# Fixed values (ours): which module consumes which event type.
EVENT_MODULE = {"click": "viewer", "view": "viewer", "purchase": "scoring", "signup": "ai_schema", "error": "detect"}
EVENT_MODULE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_MODULE.items()) + " END"


def with_module(df: DataFrame) -> DataFrame:
    m = F.lit(None).cast("string")
    for k, v in reversed(list(EVENT_MODULE.items())):
        m = F.when(F.col("event_type") == k, F.lit(v)).otherwise(m)
    return df.withColumn("module_id", m)


def tenant_modules(spark: SparkSession) -> DataFrame:
    return tenants_table(spark).join(grants_table(spark), "tier").select("tenant_id", "module_id")


GRANTS_SQL = (
    "gr AS (SELECT * FROM (VALUES "
    + ", ".join(
        f"('{t}', '{m}')"
        for t, ms in TIER_MODULES.items()
        for m in ms
    )
    + ") t(tier, module_id)), tn AS (SELECT * FROM (VALUES ('acme', 'enterprise'), ('bravo', 'basic')) t(tenant_id, tier))"
)


@register(
    "a9_training_metrics",
    f"WITH {GRANTS_SQL}, ev AS (SELECT {TENANT_SQL} AS tenant_id, {EVENT_MODULE_SQL} AS module_id, ts FROM events), "
    "ent AS (SELECT ev.* FROM ev JOIN tn USING (tenant_id) JOIN gr ON gr.tier = tn.tier AND gr.module_id = ev.module_id), "
    "m AS (SELECT tenant_id, module_id, round(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY tenant_id), 2) AS trained_pct, "
    "COUNT(*) AS data_points, MAX(ts) AS last_trained_at FROM ent GROUP BY tenant_id, module_id) "
    "SELECT tn.tenant_id, gr.module_id, COALESCE(m.trained_pct, 0.0) AS trained_pct, COALESCE(m.data_points, 0) AS data_points, "
    "m.last_trained_at, CAST(NULL AS VARCHAR) AS last_error FROM tn JOIN gr USING (tier) "
    "LEFT JOIN m ON m.tenant_id = tn.tenant_id AND m.module_id = gr.module_id",
)
def a9_training_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics written per (tenant, module) from the entitled events, read back for all granted modules."""
    root = scratch_path(spark, "metrics")
    ev = entitled(with_module(raw_logs(spark, sf_dir)), tenants_table(spark), grants_table(spark))
    per = ev.groupBy("tenant_id", "module_id").agg(F.count(F.lit(1)).alias("data_points"), F.max("ts").alias("__last"))
    share = F.round(F.col("data_points") * 100.0 / F.sum("data_points").over(Window.partitionBy("tenant_id")), 2)
    metrics = per.select(
        "tenant_id", "module_id", share.alias("trained_pct"), "data_points",
        F.col("__last").cast("timestamp").alias("last_trained_at"), F.lit(None).cast("string").alias("last_error"),
    )
    write_training_metrics(metrics, root)
    out = read_training_metrics(spark, root, tenant_modules(spark))
    return out.withColumn("last_trained_at", F.col("last_trained_at").cast("timestamp_ntz"))


@register(
    "a10_offset_ledger",
    with_views(
        "SELECT tenant_id, source_id, arg_max(CASE WHEN event_type = 'error' THEN NULL ELSE (event_id * 7919) % 100000 END, event_id) "
        "FILTER (WHERE event_type <> 'error') AS \"offset\", tenant_id || '::' || source_id AS ledger_key FROM raw_logs GROUP BY ALL",
        RAW_LOGS_SQL,
    ),
)
def a10_offset_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rl = raw_logs(spark, sf_dir).select(
        "tenant_id", "source_id", F.col("event_id").alias("seq"),
        F.when(F.col("event_type") != "error", (F.col("event_id") * 7919) % 100000).alias("offset"),
    )
    return offset_ledger(rl)


@register(
    "a2_tail_read",
    with_views(
        "SELECT raw_data, CAST(SUM(strlen(raw_data) + 1) OVER (PARTITION BY event_id // 1000 ORDER BY event_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS \"offset\" FROM raw_logs",
        RAW_LOGS_SQL,
    ),
)
def a2_tail_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tail data source read from byte 0 over the landed log files (byte ranges as partitions)."""
    path = log_files(spark, sf_dir)
    return read_log_tail(spark, path, partition_bytes=1 << 16, recursive=True).select("raw_data", "offset")
