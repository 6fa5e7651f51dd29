"""The main ingestion path on a stream: landed log files -> stamp -> header -> rule -> tenant zone.

Good rows go to the ``data/processed`` zone (partitioned by tenant and day),
rows whose rule failed go to a quarantine folder. Each output is its own
file-sink query with its own checkpoint, so both are exactly-once (the file
sink commits through its log; ``foreachBatch`` appends could repeat on retry).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signals.operators.envelope import stamp
from signals.operators.parse import ERROR, ParseRule, normalize, parse_header
from signals.sources.files import stream_logs
from signals.sources.zones import zone_root


def parsed_stream(
    spark: SparkSession,
    landing_dir: str,
    tenant_id: str,
    source_id: str,
    rule: ParseRule | dict,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of stamped, parsed lines (``parsed`` as JSON text for file sinks)."""
    lines = stamp(stream_logs(spark, landing_dir, max_files_per_trigger), tenant_id, source_id)
    p = normalize(parse_header(lines), rule, input_col="body")
    return p.withColumns({"dt": F.to_date(F.col("event_time")), "parsed_json": F.to_json(F.col("parsed"))}).drop("parsed")


def ingest_stream(
    spark: SparkSession,
    landing_dir: str,
    tenant_id: str,
    source_id: str,
    rule: ParseRule | dict,
    root: str,
    checkpoint_root: str,
    quarantine_dir: str | None = None,
    trigger_available_now: bool = False,
    max_files_per_trigger: int | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start the processed-zone query and the quarantine query; returns both."""
    p = parsed_stream(spark, landing_dir, tenant_id, source_id, rule, max_files_per_trigger)
    good = p.filter(F.col("parse_status") != F.lit(ERROR))
    bad = p.filter(F.col("parse_status") == F.lit(ERROR))
    qdir = quarantine_dir or f"{root.rstrip('/')}/quarantine"

    def start(df: DataFrame, path: str, name: str, parts: list[str]) -> StreamingQuery:
        w = (
            df.writeStream.format("parquet").partitionBy(*parts).option("path", path)
            .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{name}").outputMode("append")
            .queryName(f"{tenant_id}::{source_id}::{name}")
        )
        if trigger_available_now:
            w = w.trigger(availableNow=True)
        return w.start()

    processed = start(good, zone_root(root, "data/processed"), "processed", ["tenant_id", "dt"])
    quarantine = start(bad, qdir, "quarantine", ["tenant_id"])
    return processed, quarantine
