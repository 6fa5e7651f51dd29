"""Queries for schema inference, the catalog and artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.operators.parse import DATETIME_PATTERN, INTEGER_PATTERN, IPV4_PATTERN
from signals.operators.schema import (
    catalog_from_inference,
    current_schema,
    history_rows,
    infer_schema,
    list_artifacts,
    revise_schema,
    schema_diff,
    schema_fit,
    schema_quality,
    training_history,
    append_history,
)
from signals.plans.fixtures import TENANT_SQL
from signals.plans.q_parse import fields_map, parsed_logs
from signals.plans.registry import register
from signals.session import materialize, scratch_path
from signals.sources.artifacts import read_schema_artifacts, schema_documents, write_schema_artifacts

RUN_1 = "2024-02-01 00:00:00"
RUN_2 = "2024-02-02 06:30:00"


def _re2(p: str) -> str:
    """Our anchored Java patterns as RE2 full-match bodies for the oracle."""
    assert p.startswith("^") and p.endswith("\\z")
    return p[1:-2]


def inferred(spark: SparkSession, sf_dir: str, threshold: float = 0.9) -> DataFrame:
    return infer_schema(fields_map(parsed_logs(spark, sf_dir)), "fields", threshold=threshold)


# --- oracle building blocks: the same key/value pairs, read from typed event columns
KV_SQL = (
    "kv AS (SELECT tenant_id, log_type, substr(name, 3) AS name, v FROM ("
    f"SELECT {TENANT_SQL} AS tenant_id, event_type AS log_type, "
    "strftime(ts, '%Y-%m-%dT%H:%M:%S') AS k_event_time, "
    "'192.168.105.' || CAST(10 + user_id % 21 AS VARCHAR) AS k_sender_ip, "
    "'user' || CAST(user_id AS VARCHAR) AS k_user, event_type AS k_action, "
    "'10.1.1.' || CAST(1 + user_id % 254 AS VARCHAR) AS k_srcip, CAST(event_id AS VARCHAR) AS k_bytes, "
    "CAST(event_id % 4 AS VARCHAR) AS k_priority, CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) AS k_value FROM events) "
    "UNPIVOT (v FOR name IN (k_event_time, k_sender_ip, k_user, k_action, k_srcip, k_bytes, k_priority, k_value)))"
)
ROWS_SQL = f"nr AS (SELECT {TENANT_SQL} AS tenant_id, event_type AS log_type, COUNT(*) AS n_rows FROM events GROUP BY ALL)"
AGG_SQL = (
    "ag AS (SELECT tenant_id, log_type, name, COUNT(*) AS n_present, COUNT(*) FILTER (WHERE v <> '') AS n_values, "
    f"COUNT(*) FILTER (WHERE v <> '' AND regexp_full_match(v, '{_re2(DATETIME_PATTERN)}') "
    "AND try_cast(substr(v, 1, 10) AS DATE) IS NOT NULL) AS n_dt, "
    f"COUNT(*) FILTER (WHERE v <> '' AND regexp_full_match(v, '{_re2(IPV4_PATTERN)}')) AS n_ip, "
    f"COUNT(*) FILTER (WHERE v <> '' AND regexp_full_match(v, '{_re2(INTEGER_PATTERN)}')) AS n_int "
    "FROM kv GROUP BY ALL)"
)


def _d1_sql(num: int, den: int) -> str:
    ok = lambda n: f"(n_values > 0 AND {n} * {den} >= n_values * {num})"
    return (
        "d1 AS (SELECT tenant_id, log_type, name, typ AS type, CAST(pct AS VARCHAR) || '%' AS confidence, "
        "pct AS confidence_pct, n_rows, n_present, n_values, "
        "CAST(CASE WHEN typ = 'string' THEN n_values ELSE m END AS BIGINT) AS n_match FROM ("
        "SELECT *, CAST(CASE WHEN d > 0 THEN (m * 100) // d ELSE 0 END AS BIGINT) AS pct FROM ("
        f"SELECT ag.*, nr.n_rows, CASE WHEN {ok('n_dt')} THEN 'datetime' WHEN {ok('n_ip')} THEN 'ip_address' "
        f"WHEN {ok('n_int')} THEN 'integer' ELSE 'string' END AS typ, "
        f"CASE WHEN {ok('n_dt')} THEN n_dt WHEN {ok('n_ip')} THEN n_ip WHEN {ok('n_int')} THEN n_int ELSE n_present END AS m, "
        f"CASE WHEN {ok('n_dt')} OR {ok('n_ip')} OR {ok('n_int')} THEN n_values ELSE nr.n_rows END AS d "
        "FROM ag JOIN nr USING (tenant_id, log_type))))"
    )


D1_CTES = f"WITH {KV_SQL}, {ROWS_SQL}, {AGG_SQL}, {_d1_sql(9, 10)}"
D2_CTE = (
    "d2 AS (SELECT tenant_id, log_type, round(100.0 * SUM(n_match) / SUM(n_values), 2) AS accuracy, "
    "CAST(MAX(n_rows) AS BIGINT) AS processed_count FROM d1 GROUP BY ALL)"
)
CAT_CTE = (
    "cat AS (SELECT tenant_id, log_type, 1 AS version, "
    "CAST(row_number() OVER (PARTITION BY tenant_id, log_type ORDER BY name) - 1 AS INTEGER) AS pos, name, type, confidence FROM d1)"
)


@register("d1_infer_schema", f"{D1_CTES} SELECT * FROM d1")
def d1_infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inferred(spark, sf_dir)


@register("d2_schema_quality", f"{D1_CTES}, {D2_CTE} SELECT * FROM d2")
def d2_schema_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_quality(inferred(spark, sf_dir))


@register(
    "d3_append_history",
    f"{D1_CTES}, {D2_CTE} SELECT tenant_id, log_type, accuracy, CAST(processed_count AS BIGINT) AS processed_count, "
    "'schema_' || log_type || '_20240201_000000.xml' AS file_name, TIMESTAMP '2024-02-01 00:00:00' AS created_at FROM d2",
)
def d3_append_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append one training run to a fresh history table and read it back."""
    path = scratch_path(spark, "history")
    rows = history_rows(schema_quality(inferred(spark, sf_dir)), "/tenants", F.to_timestamp(F.lit(RUN_1)))
    append_history(rows, path)
    back = spark.read.parquet(path)
    return back.select(
        "tenant_id", "log_type", "accuracy", "processed_count",
        F.substring_index("xml_file_path", "/", -1).alias("file_name"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
    )


def stored(df: DataFrame) -> DataFrame:
    """Materialise a small catalog-sized result once (checkpoint in the shared folder).

    Inference reads every log line; the catalog steps that follow reuse its
    small output several times, so it is stored once, as the catalog table
    would be, instead of being recomputed per reference.
    """
    return materialize(df)


def two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = stored(schema_quality(inferred(spark, sf_dir)))
    return history_rows(q, "/tenants", F.to_timestamp(F.lit(RUN_1)), "r1").unionByName(
        history_rows(q, "/tenants", F.to_timestamp(F.lit(RUN_2)), "r2")
    )


TWO_RUNS_CTE = (
    "runs AS (SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS created_at, '20240201_000000' AS stamp FROM d2 "
    "UNION ALL SELECT *, TIMESTAMP '2024-02-02 06:30:00', '20240202_063000' FROM d2)"
)


@register(
    "d4_training_history",
    f"{D1_CTES}, {D2_CTE}, {TWO_RUNS_CTE} SELECT row_number() OVER (ORDER BY created_at DESC, log_type) AS rank, "
    "log_type, printf('%.2f', accuracy) || '%' AS accuracy_display, format('{:,}', processed_count) AS processed_display, "
    "created_at FROM runs WHERE tenant_id = 'acme'",
)
def d4_training_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = training_history(two_runs(spark, sf_dir), "acme")
    return h.select("rank", "log_type", "accuracy_display", "processed_display", F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@register(
    "d5_list_artifacts",
    f"{D1_CTES}, {D2_CTE}, {TWO_RUNS_CTE} SELECT tenant_id, 'schema_' || log_type || '_' || stamp || '.xml' AS file_name, "
    "log_type AS artifact_type, created_at AS artifact_time FROM runs",
)
def d5_list_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = list_artifacts(two_runs(spark, sf_dir))
    return a.withColumn("artifact_time", F.col("artifact_time").cast("timestamp_ntz"))


def revised_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v1 from inference; acme/error: drop position 1 and add a default field; bravo/click: all text."""
    cat = stored(catalog_from_inference(inferred(spark, sf_dir)))
    cat = revise_schema(cat, "acme", "error", remove=[1], add=1)
    text = [(n, "string", "Manual") for n in ("action", "bytes", "event_time", "priority", "sender_ip", "srcip", "user", "value")]
    return revise_schema(cat, "bravo", "click", replace=text)


REV_CTE = (
    "rev AS (SELECT tenant_id, log_type, 2 AS version, CAST(row_number() OVER (ORDER BY pos) - 1 AS INTEGER) AS pos, "
    "name, type, confidence FROM cat WHERE tenant_id = 'acme' AND log_type = 'error' AND pos <> 1 "
    "UNION ALL SELECT 'acme', 'error', 2, CAST((SELECT COUNT(*) FROM cat WHERE tenant_id = 'acme' AND log_type = 'error') - 1 AS INTEGER), "
    "'new_field', 'string', 'Manual' "
    "UNION ALL SELECT 'bravo', 'click', 2, CAST(row_number() OVER (ORDER BY name) - 1 AS INTEGER), name, 'string', 'Manual' "
    "FROM (SELECT unnest(['action', 'bytes', 'event_time', 'priority', 'sender_ip', 'srcip', 'user', 'value']) AS name)), "
    "cur AS (SELECT * FROM cat WHERE NOT ((tenant_id = 'acme' AND log_type = 'error') OR (tenant_id = 'bravo' AND log_type = 'click')) "
    "UNION ALL SELECT * FROM rev)"
)


@register("d6_revise_schema", f"{D1_CTES}, {CAT_CTE}, {REV_CTE} SELECT * FROM cur")
def d6_revise_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_schema(revised_catalog(spark, sf_dir))


@register(
    "d7_schema_diff",
    f"{D1_CTES}, {CAT_CTE}, {REV_CTE} SELECT COALESCE(b.tenant_id, a.tenant_id) AS tenant_id, "
    "COALESCE(b.log_type, a.log_type) AS log_type, COALESCE(b.name, a.name) AS name, b.type AS before_type, a.type AS after_type, "
    "CASE WHEN b.type IS NULL THEN 'added' WHEN a.type IS NULL THEN 'removed' WHEN b.type IS DISTINCT FROM a.type THEN 'changed' "
    "ELSE 'same' END AS verdict FROM cat b FULL OUTER JOIN cur a ON b.tenant_id = a.tenant_id AND b.log_type = a.log_type AND b.name = a.name",
)
def d7_schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = revised_catalog(spark, sf_dir)
    return schema_diff(cat.filter(F.col("version") == 1), current_schema(cat))


DOC_SQL = (
    "SELECT tenant_id, log_type, 'schema_' || log_type || '_20240201_000000.xml' AS artifact, "
    "'<LogSchema tenant=\"' || tenant_id || '\" type=\"' || log_type || '\">' || chr(10) || "
    "string_agg('    <Field name=\"' || name || '\" type=\"' || type || '\" confidence=\"' || confidence || '\"/>', chr(10) ORDER BY pos) "
    "|| chr(10) || '</LogSchema>' AS xml FROM cat GROUP BY tenant_id, log_type"
)


@register("a8_write_artifacts", f"{D1_CTES}, {CAT_CTE} {DOC_SQL}")
def a8_write_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = catalog_from_inference(inferred(spark, sf_dir))
    return schema_documents(cat, F.to_timestamp(F.lit(RUN_1)))


@register(
    "a7_read_artifacts",
    f"{D1_CTES}, {CAT_CTE} SELECT tenant_id AS tenant, log_type, tenant_id, "
    "'schema_' || log_type || '_20240201_000000.xml' AS artifact, pos, name, type, confidence FROM cat",
)
def a7_read_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the v1 catalog as XML documents (A8), read them back."""
    root = scratch_path(spark, "artifacts")
    write_schema_artifacts(catalog_from_inference(inferred(spark, sf_dir)), root, F.to_timestamp(F.lit(RUN_1)))
    return read_schema_artifacts(spark, root).drop("file_name")


# A hand-edited acme/purchase schema with two wrong types (user as an address, value as an integer).
MISTYPED = [
    ("action", "string", "Manual"), ("bytes", "integer", "Manual"), ("event_time", "datetime", "Manual"),
    ("priority", "integer", "Manual"), ("sender_ip", "ip_address", "Manual"), ("srcip", "ip_address", "Manual"),
    ("user", "ip_address", "Manual"), ("value", "integer", "Manual"),
]
MISTYPED_SQL = (
    "cur2 AS (SELECT * FROM cur WHERE NOT (tenant_id = 'acme' AND log_type = 'purchase') UNION ALL "
    "SELECT 'acme', 'purchase', 2, CAST(p AS INTEGER), n, t, 'Manual' FROM (VALUES "
    + ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t, _) in enumerate(MISTYPED))
    + ") v(p, n, t))"
)


@register(
    "d2_schema_fit",
    f"{D1_CTES}, {CAT_CTE}, {REV_CTE}, {MISTYPED_SQL}, "
    "fit AS (SELECT kv.tenant_id, kv.log_type, cur2.type, kv.v FROM kv JOIN cur2 ON kv.tenant_id = cur2.tenant_id "
    "AND kv.log_type = cur2.log_type AND kv.name = cur2.name WHERE kv.v <> '') "
    "SELECT nr.tenant_id, nr.log_type, CAST(CASE WHEN COUNT(fit.v) > 0 THEN round(100.0 * COUNT(fit.v) FILTER (WHERE "
    f"(fit.type = 'datetime' AND regexp_full_match(fit.v, '{_re2(DATETIME_PATTERN)}') AND try_cast(substr(fit.v, 1, 10) AS DATE) IS NOT NULL) "
    f"OR (fit.type = 'ip_address' AND regexp_full_match(fit.v, '{_re2(IPV4_PATTERN)}')) "
    f"OR (fit.type = 'integer' AND regexp_full_match(fit.v, '{_re2(INTEGER_PATTERN)}')) "
    "OR fit.type NOT IN ('datetime', 'ip_address', 'integer')) / COUNT(fit.v), 2) ELSE 100.0 END AS DOUBLE) AS accuracy, "
    "nr.n_rows AS processed_count FROM nr LEFT JOIN fit ON fit.tenant_id = nr.tenant_id AND fit.log_type = nr.log_type "
    "GROUP BY nr.tenant_id, nr.log_type, nr.n_rows",
)
def d2_schema_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit of hand-revised schemas to the data: the D6 revisions plus a mistyped acme/purchase schema."""
    cat = revise_schema(revised_catalog(spark, sf_dir), "acme", "purchase", replace=MISTYPED)
    return schema_fit(fields_map(parsed_logs(spark, sf_dir)), current_schema(cat), "fields")
