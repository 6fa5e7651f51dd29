"""Training-metric reader (A9): one JSON document per (tenant, module).

Missing metric -> (0.0, 0, null, null); unreadable JSON -> the same with
``last_error`` set. Module ids with '/' map to file names with '_'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.functions.text import safe_module_name
from signals.session import path_exists

# ISO-8601 with microseconds and a numeric offset, as Python's isoformat() writes times.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
METRIC_SCHEMA = "trained_pct double, data_points long, last_trained_at timestamp, last_error string, _corrupt string"


def write_training_metrics(metrics: DataFrame, root: str) -> None:
    """Write (tenant_id, module_id, trained_pct, data_points, last_trained_at, last_error) as JSON,
    one folder per tenant and safe module name."""
    m = metrics.withColumn("module", safe_module_name(F.col("module_id"))).drop("module_id")
    m.write.mode("append").partitionBy("tenant_id", "module").option("timestampFormat", ISO_MICROS).json(root)


def read_training_metrics(spark: SparkSession, root: str, modules: DataFrame, layout: str = "partitioned") -> DataFrame:
    """Metrics for every (tenant_id, module_id) in ``modules``, with defaults.

    ``layout="partitioned"``: JSON below ``{root}/tenant_id=<t>/module=<safe id>/``
    (what ``write_training_metrics`` writes). ``layout="files"``: one file per
    module, ``{root}/<tenant>/metrics/<safe id>.json`` (tenant folders as the
    reference keeps them). A document may be pretty-printed; times are
    ISO-8601 (any fraction, ``Z`` or a numeric offset). A missing document
    gives ``0.0, 0, null, null``; a corrupt one the same with
    ``last_error = 'metric read error: malformed JSON'``.
    """
    reader = (
        spark.read.schema(METRIC_SCHEMA)
        .option("multiLine", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
    )
    if layout not in ("partitioned", "files"):
        raise ValueError("layout must be 'partitioned' or 'files'")
    partitions = "tenant_id string, module string" if layout == "partitioned" else ""
    pattern = f"{root.rstrip('/')}/*" + ("/metrics/*.json" if layout == "files" else "")
    if not path_exists(spark, pattern):
        # no metric was ever written, whatever else the tenants' folders hold: every metric has its defaults
        raw, got = None, spark.createDataFrame([], "__t string, __m string, __bad boolean, trained_pct double, data_points long, last_trained_at timestamp, last_error string")
    elif layout == "partitioned":
        raw = reader.schema(f"{METRIC_SCHEMA}, {partitions}").json(root)  # ids are strings, also '0042'
        got = raw.select(F.col("tenant_id").alias("__t"), F.col("module").alias("__m"), *_metric_cols())
    else:
        raw = reader.json(pattern)
        path = F.col("_metadata.file_path")
        parts = F.split(path, "/")
        tenant = F.element_at(parts, -3)
        module = F.regexp_replace(F.element_at(parts, -1), r"\.json$", "")
        got = raw.select(tenant.alias("__t"), module.alias("__m"), *_metric_cols())
    j = modules.join(got, (modules["tenant_id"] == F.col("__t")) & (safe_module_name(modules["module_id"]) == F.col("__m")), "left")
    bad = F.coalesce(F.col("__bad"), F.lit(False))
    return j.select(
        modules["tenant_id"], modules["module_id"],
        F.when(bad, F.lit(0.0)).otherwise(F.coalesce(F.col("trained_pct"), F.lit(0.0))).alias("trained_pct"),
        F.when(bad, F.lit(0)).otherwise(F.coalesce(F.col("data_points"), F.lit(0))).cast("long").alias("data_points"),
        F.when(~bad, F.col("last_trained_at")).alias("last_trained_at"),
        F.when(bad, F.lit("metric read error: malformed JSON")).otherwise(F.col("last_error")).alias("last_error"),
    )


def _metric_cols():
    return [
        F.col("_corrupt").isNotNull().alias("__bad"),
        "trained_pct", "data_points", "last_trained_at", "last_error",
    ]
