"""Queries for tenancy and source health."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.operators.tenancy import all_healthy, eps_violations, entitled, grants_table, limits_table, source_status, tenants_table, valid_tenant
from signals.plans.fixtures import RAW_LOGS_SQL, TENANT_SQL, raw_logs, table, with_views
from signals.plans.q_sources import EVENT_MODULE_SQL, GRANTS_SQL, with_module
from signals.plans.registry import register


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event read as a poll report of its source: errors are failed polls, signups empty polls."""
    rl = raw_logs(spark, sf_dir)
    et = F.col("event_type")
    return rl.select(
        "tenant_id", "source_id", "ts",
        (et != "signup").alias("running"),
        (et != "error").alias("healthy"),
        F.when(et == "error", F.concat(F.lit("open failed at event "), F.col("event_id").cast("string"))).alias("error"),
        F.when(et.isin("error", "signup"), F.lit(0)).otherwise(F.lit(1)).alias("n_records"),
        F.concat(F.lit('{"source": "'), F.col("source_id"), F.lit('"}')).alias("config"),
    )


STATUS_SQL = (
    "st AS (SELECT tenant_id, source_id, arg_max(event_type <> 'signup', ts) AS running, arg_max(event_type <> 'error', ts) AS h, "
    "MAX(ts) FILTER (WHERE event_type = 'error') AS err_ts, "
    "arg_max('open failed at event ' || CAST(event_id AS VARCHAR), ts) FILTER (WHERE event_type = 'error') AS err, "
    "MAX(ts) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS data_ts, MAX(ts) AS last_report, "
    "'{\"source\": \"' || source_id || '\"}' AS config FROM raw_logs GROUP BY tenant_id, source_id), "
    "st2 AS (SELECT tenant_id, source_id, running, h AND NOT pending AS healthy, CASE WHEN pending THEN err END AS last_error, "
    "config, last_report FROM (SELECT *, err_ts IS NOT NULL AND (data_ts IS NULL OR data_ts < err_ts) AS pending FROM st))"
)


@register("e1_source_status", with_views("SELECT * FROM st2", RAW_LOGS_SQL, STATUS_SQL))
def e1_source_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = source_status(reports(spark, sf_dir))
    return s.withColumn("last_report", F.col("last_report").cast("timestamp_ntz"))


@register(
    "e2_all_healthy",
    with_views("SELECT COALESCE(bool_and(healthy AND running), true) AS all_healthy FROM st2", RAW_LOGS_SQL, STATUS_SQL),
)
def e2_all_healthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_healthy(source_status(reports(spark, sf_dir)))


@register(
    "e3_entitled",
    f"WITH {GRANTS_SQL} SELECT event_id, tenant_id, module_id FROM (SELECT event_id, {TENANT_SQL} AS tenant_id, "
    f"{EVENT_MODULE_SQL} AS module_id FROM events) ev JOIN tn USING (tenant_id) "
    "WHERE EXISTS (SELECT 1 FROM gr WHERE gr.tier = lower(tn.tier) AND gr.module_id = ev.module_id)",
)
def e3_entitled(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = with_module(raw_logs(spark, sf_dir))
    return entitled(ev, tenants_table(spark, {"acme": "Enterprise", "bravo": "BASIC"}), grants_table(spark)).select(
        "event_id", "tenant_id", "module_id"
    )


@register(
    "e4_valid_tenant",
    "SELECT event_id, regexp_full_match('tenant_' || event_type || '_' || CAST(user_id AS VARCHAR), '[a-zA-Z0-9_-]{2,64}') AS v_name, "
    "regexp_full_match(props, '[a-zA-Z0-9_-]{2,64}') AS v_props, "
    "regexp_full_match(substr(event_type, 1, CAST(event_id % 3 AS INTEGER)), '[a-zA-Z0-9_-]{2,64}') AS v_short, "
    "regexp_full_match(repeat(event_type, 14), '[a-zA-Z0-9_-]{2,64}') AS v_long FROM events",
)
def e4_valid_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        valid_tenant(F.concat(F.lit("tenant_"), F.col("event_type"), F.lit("_"), F.col("user_id").cast("string"))).alias("v_name"),
        valid_tenant("props").alias("v_props"),
        valid_tenant(F.substr(F.col("event_type"), F.lit(1), (F.col("event_id") % 3).cast("int"))).alias("v_short"),
        valid_tenant(F.repeat(F.col("event_type"), 14)).alias("v_long"),
    )


@register(
    "e5_eps_violations",
    f"SELECT tenant_id, date_trunc('hour', ts) AS window_start, COUNT(*) AS n_events, "
    "CAST(round(max_eps * 3600, 4) AS DOUBLE) AS allowed, CAST(round(COUNT(*) - max_eps * 3600, 4) AS DOUBLE) AS overage FROM (SELECT *, "
    f"{TENANT_SQL} AS tenant_id FROM events) JOIN (VALUES ('acme', 0.001), ('bravo', 0.0005)) l(tid, max_eps) ON tid = tenant_id "
    "GROUP BY tenant_id, window_start, max_eps HAVING COUNT(*) > max_eps * 3600",
)
def e5_eps_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = eps_violations(raw_logs(spark, sf_dir), limits_table(spark, {"acme": (0.001, 10), "bravo": (0.0005, 1)}), "ts", per="1 hour")
    return v.withColumn("allowed", F.round("allowed", 4)).withColumn("overage", F.round("overage", 4))
