"""Queries for the source envelope and the bounded tails."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.operators.envelope import stamp
from signals.operators.tail import latest_global, latest_per_source, latest_view, retain_latest
from signals.plans.fixtures import RAW_LOGS_SQL, raw_logs, with_views
from signals.plans.registry import register
from signals.sources.datagram import datagram_envelope

OUT = ("event_id", "tenant_id", "source_id", "raw_data")


@register(
    "b1_stamp",
    with_views("SELECT event_id, 'tenant_x' AS tenant_id, 'src_y' AS source_id, raw_data FROM raw_logs", RAW_LOGS_SQL),
)
def b1_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(raw_logs(spark, sf_dir), "tenant_x", "src_y").select(*OUT)


@register(
    "b2_latest_global",
    with_views("SELECT event_id, tenant_id, source_id, raw_data FROM raw_logs ORDER BY event_id DESC LIMIT 50", RAW_LOGS_SQL),
)
def b2_latest_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_global(raw_logs(spark, sf_dir), "event_id", 50).select(*OUT)


@register(
    "b3_latest_per_source",
    with_views(
        "SELECT * FROM (SELECT event_id, tenant_id, source_id, raw_data, "
        "row_number() OVER (PARTITION BY tenant_id, source_id ORDER BY event_id DESC) AS rn FROM raw_logs) WHERE rn <= 50",
        RAW_LOGS_SQL,
    ),
)
def b3_latest_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = latest_per_source(raw_logs(spark, sf_dir), "event_id", 50)
    return res.select(*OUT, F.col("rn").cast("bigint").alias("rn"))


@register(
    "b4_retain_latest",
    with_views(
        "SELECT event_id, tenant_id, source_id, raw_data, rs <= 2000 AS in_source_ring, rg <= 3000 AS in_global_ring FROM ("
        "SELECT *, row_number() OVER (PARTITION BY tenant_id, source_id ORDER BY event_id DESC) AS rs, "
        "row_number() OVER (ORDER BY event_id DESC) AS rg FROM raw_logs) WHERE rs <= 2000 OR rg <= 3000",
        RAW_LOGS_SQL,
    ),
)
def b4_retain_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = retain_latest(raw_logs(spark, sf_dir).select(*OUT), "event_id", "event_id", per_source=2000, total=3000)
    return res


@register(
    "b5_latest_view",
    with_views(
        "SELECT * FROM (SELECT event_id, tenant_id, source_id, raw_data FROM raw_logs ORDER BY event_id DESC LIMIT 50) "
        "WHERE tenant_id = 'bravo' AND source_id = 'syslog_event'",
        RAW_LOGS_SQL,
    ),
)
def b5_latest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_view(raw_logs(spark, sf_dir), "event_id", "bravo", "syslog_event", 50).select(*OUT)


def landed_datagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines as landed datagram payloads: padded with blanks, a bad byte before error lines."""
    rl = raw_logs(spark, sf_dir)
    bad = F.when(F.col("event_type") == "error", F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    payload = F.concat(F.encode(F.lit(" \t"), "UTF-8"), bad, F.encode(F.concat(F.col("raw_data"), F.lit("\r\n")), "UTF-8"))
    return rl.select(
        "tenant_id", "source_id",
        F.col("event_id").alias("payload_id"),
        payload.alias("payload"),
        F.col("ts").alias("received_at"),
        F.when(F.col("event_type") != "view", F.concat(F.lit("192.168.105."), (F.lit(10) + F.col("user_id") % 21).cast("string"))).alias("remote_ip"),
        (F.lit(514) + F.col("user_id") % 7).cast("int").alias("remote_port"),
    )


@register(
    "a4_datagram_envelope",
    with_views(
        "SELECT event_id, CASE WHEN event_type = 'error' THEN chr(65533) || raw_data ELSE raw_data END AS raw_data, "
        "CAST(0 AS BIGINT) AS \"offset\", "
        "row_number() OVER (PARTITION BY tenant_id, source_id ORDER BY ts, event_id) AS seq, "
        "CASE WHEN event_type <> 'view' THEN '192.168.105.' || CAST(10 + user_id % 21 AS VARCHAR) END AS remote_ip, "
        "CASE WHEN event_type <> 'view' THEN CAST(514 + user_id % 7 AS INTEGER) END AS remote_port FROM raw_logs",
        RAW_LOGS_SQL,
    ),
)
def a4_datagram_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = datagram_envelope(landed_datagrams(spark, sf_dir))
    return env.select(
        F.col("payload_id").alias("event_id"), "raw_data", "offset", "seq",
        F.col("remote_addr.ip").alias("remote_ip"), F.col("remote_addr.port").alias("remote_port"),
    )


_BURST = "TIMESTAMP '2024-01-10 12:34:56.5'"


@register(
    "a4_hot_minute",
    with_views(
        f"SELECT event_id, row_number() OVER (PARTITION BY tenant_id, source_id ORDER BY CASE WHEN event_id % 3 = 0 THEN {_BURST} ELSE ts END, event_id) AS seq FROM raw_logs",
        RAW_LOGS_SQL,
    ),
)
def a4_hot_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the datagrams arrive at one time: they are numbered in parts of about 256."""
    landed = landed_datagrams(spark, sf_dir)
    burst = F.when(F.col("payload_id") % 3 == 0, F.lit("2024-01-10 12:34:56.5").cast("timestamp_ntz")).otherwise(F.col("received_at"))
    env = datagram_envelope(landed.withColumn("received_at", burst), max_rows=256)
    return env.select(F.col("payload_id").alias("event_id"), "seq")


@register(
    "b3_burst_ring",
    with_views(
        f"SELECT event_id, source_id, row_number() OVER (PARTITION BY tenant_id, source_id ORDER BY t DESC, event_id DESC) AS rn "
        f"FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN {_BURST} ELSE ts END AS t FROM raw_logs) QUALIFY rn <= 1500",
        RAW_LOGS_SQL,
    ),
)
def b3_burst_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings of 1,500 by time where a third of the events have one time."""
    burst = F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-10 12:34:56.5").cast("timestamp_ntz")).otherwise(F.col("ts"))
    logs = raw_logs(spark, sf_dir).withColumn("t", burst)
    return latest_per_source(logs, ["t", "event_id"], 1500, max_rows=256).select("event_id", "source_id", F.col("rn").cast("long").alias("rn"))
