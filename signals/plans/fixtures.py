"""Fixture views built from the driver's ``events`` table.

``raw_logs`` turns each event into a syslog-style log line, stamped with a
tenant and a source. The same expressions exist as DuckDB SQL (``RAW_LOGS_SQL``)
so the oracle can read identical lines; oracles for the parsing operators
read the typed ``events`` columns instead, which keeps them independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _line(ev: DataFrame) -> Column:
    uid, eid = F.col("user_id"), F.col("event_id")
    return F.concat(
        F.lit("<14>1 "),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit(" ["), F.col("event_type"), F.lit("] [192.168.105."), _s(F.lit(10) + uid % 21),
        F.lit("] user=user"), _s(uid),
        F.lit(" action="), F.col("event_type"),
        F.lit(" srcip=10.1.1."), _s(F.lit(1) + uid % 254),
        F.lit(" bytes="), _s(eid),
        F.lit(" priority="), _s(eid % 4),
        F.lit(" value="), _s(F.col("value").cast("decimal(10,2)")),
    )


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (event_id, ts, user_id, event_type, value, tenant_id, source_id, raw_data)."""
    return logs_from_events(table(spark, sf_dir, "events"))


def logs_from_events(events: DataFrame) -> DataFrame:
    """The raw_logs projection for any events DataFrame, batch or streaming."""
    ev = events.select("event_id", "ts", "user_id", "event_type", "value")
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.when(F.col("user_id") % 3 != 0, F.lit("acme")).otherwise(F.lit("bravo")).alias("tenant_id"),
        F.when(F.col("event_id") % 2 == 0, F.lit("file_event")).otherwise(F.lit("syslog_event")).alias("source_id"),
        _line(ev).alias("raw_data"),
    )


def deny_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_logs lines carrying the deny keys used by the SYN-flood preset."""
    rl = raw_logs(spark, sf_dir)
    extra = F.concat(
        F.lit(" dstip=10.9.1."), _s(F.lit(1) + F.col("user_id") % 20),
        F.lit(" protocol=TCP tcpflag="),
        F.when(F.col("event_type") == "error", F.lit("SYN")).otherwise(F.lit("ACK")),
        F.lit(" packets="), _s(F.lit(1) + F.col("event_id") % 50),
    )
    return rl.withColumn("raw_data", F.concat(F.col("raw_data"), extra))


TENANT_SQL = "CASE WHEN user_id % 3 <> 0 THEN 'acme' ELSE 'bravo' END"
SOURCE_SQL = "CASE WHEN event_id % 2 = 0 THEN 'file_event' ELSE 'syslog_event' END"
LINE_SQL = (
    "'<14>1 ' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || ' [' || event_type || '] [192.168.105.' "
    "|| CAST(10 + user_id % 21 AS VARCHAR) || '] user=user' || CAST(user_id AS VARCHAR) "
    "|| ' action=' || event_type || ' srcip=10.1.1.' || CAST(1 + user_id % 254 AS VARCHAR) "
    "|| ' bytes=' || CAST(event_id AS VARCHAR) || ' priority=' || CAST(event_id % 4 AS VARCHAR) "
    "|| ' value=' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR)"
)
DENY_EXTRA_SQL = (
    "' dstip=10.9.1.' || CAST(1 + user_id % 20 AS VARCHAR) || ' protocol=TCP tcpflag=' "
    "|| CASE WHEN event_type = 'error' THEN 'SYN' ELSE 'ACK' END "
    "|| ' packets=' || CAST(1 + event_id % 50 AS VARCHAR)"
)
RAW_LOGS_SQL = (
    "raw_logs AS (SELECT event_id, ts, user_id, event_type, value, "
    f"{TENANT_SQL} AS tenant_id, {SOURCE_SQL} AS source_id, {LINE_SQL} AS raw_data FROM events)"
)
DENY_LOGS_SQL = (
    "deny_logs AS (SELECT event_id, ts, user_id, event_type, value, "
    f"{TENANT_SQL} AS tenant_id, {SOURCE_SQL} AS source_id, ({LINE_SQL}) || {DENY_EXTRA_SQL} AS raw_data FROM events)"
)


def with_views(sql: str, *views: str) -> str:
    """Prefix an oracle query with the fixture CTEs it needs."""
    if not views:
        return sql
    return "WITH " + ", ".join(views) + " " + sql
