"""Tenancy and source health."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.session import small_table
from signals.streaming.time import bound_of, event_time_for

# Modules granted per license tier.
TIER_MODULES = {
    "basic": ["parser", "viewer", "detect", "scoring", "workflow"],
    "standard": ["parser", "viewer", "ai_schema", "detect", "ml_detect", "scoring", "workflow", "soar_api"],
    "enterprise": [
        "parser", "viewer", "ai_schema", "detect", "ml_detect", "scoring", "workflow", "soar_api",
        "advanced_soar", "deploy", "grep_pipeline",
    ],
}
# Tenants, tiers and limits of the sample license.
TENANT_TIERS = {"acme": "enterprise", "bravo": "basic"}
TENANT_LIMITS = {"acme": (2000, 10), "bravo": (200, 1)}

TENANT_ID_PATTERN = r"^[a-zA-Z0-9_-]{2,64}\z"


def grants_table(spark: SparkSession, tiers: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(tier, module_id) rows: basic 5, standard 8, enterprise 11."""
    t = tiers or TIER_MODULES
    return small_table(spark, [(k, m) for k, ms in t.items() for m in ms], "tier string, module_id string")


def tenants_table(spark: SparkSession, tiers: Mapping[str, str] | None = None) -> DataFrame:
    t = tiers or TENANT_TIERS
    return small_table(spark, list(t.items()), "tenant_id string, tier string")


def limits_table(spark: SparkSession, limits: Mapping[str, tuple[float, int]] | None = None) -> DataFrame:
    l = limits or TENANT_LIMITS
    return small_table(spark, [(k, float(e), int(m)) for k, (e, m) in l.items()], "tenant_id string, max_eps double, max_models int")


def valid_tenant(c: Column | str) -> Column:
    """2-64 characters of [a-zA-Z0-9_-] (E4); null is not valid."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.rlike(TENANT_ID_PATTERN), F.lit(False))


def entitled(df: DataFrame, tenants: DataFrame, grants: DataFrame, module_col: str = "module_id") -> DataFrame:
    """Keep rows whose module is granted to their tenant's tier.

    The tier is lower-cased; a tenant with an unknown tier (or none) keeps
    nothing, one with several tiers keeps what any of them grants. The two
    dimension tables are joined first; the semi-join keeps each row once.
    """
    t = tenants.select(F.col("tenant_id").alias("__t"), F.lower(F.col("tier")).alias("__tier"))
    g = grants.select(F.col("tier").alias("__g_tier"), F.col("module_id").alias("__g_mod"))
    allowed = t.join(g, F.col("__tier") == F.col("__g_tier")).select("__t", "__g_mod")
    return df.join(allowed, (F.col("tenant_id") == F.col("__t")) & (F.col(module_col) == F.col("__g_mod")), "left_semi")


def source_status(
    reports: DataFrame,
    key: Sequence[str] = ("tenant_id", "source_id"),
    ts_col: str = "ts",
    order: Sequence[str] = (),
) -> DataFrame:
    """Per (tenant, source): running, healthy, last_error, config.

    ``reports`` are poll/progress rows (``running``, ``healthy``, ``error``,
    ``n_records``, ``config``), e.g. written by ``signals.streaming.listener``.
    State comes from the newest report; of reports with the same ``ts`` the
    one that is last in the ``order`` columns (e.g. a batch number). An error stays reported until a
    later report delivered data (the reference cleared it on the next empty
    poll); a source with a pending error is not healthy.
    """
    k = list(key)
    ts = F.struct(F.col(ts_col), *order)
    failed = F.col("error").isNotNull()
    g = reports.groupBy(*k).agg(
        # ties that no order column breaks go to the greatest state, so results don't depend on the rows' order
        F.max_by(F.struct("running", "healthy", "config"), F.struct(ts, "running", "healthy", F.col("config").cast("string").alias("text"))).alias("__last"),
        F.max(F.when(failed, ts)).alias("__err_ts"),
        F.max(F.when(failed, F.struct(ts.alias("at"), F.col("error").alias("error")))).alias("__err_row"),
        F.max(F.when(F.col("n_records") > 0, ts)).alias("__data_ts"),
        F.max(F.col(ts_col)).alias("last_report"),
    ).withColumn("__err", F.col("__err_row.error"))
    pending = F.col("__err_ts").isNotNull() & (F.col("__data_ts").isNull() | (F.col("__data_ts") < F.col("__err_ts")))
    return g.select(
        *k,
        F.col("__last.running").alias("running"),
        (F.col("__last.healthy") & ~pending).alias("healthy"),
        F.when(pending, F.col("__err")).alias("last_error"),
        F.col("__last.config").alias("config"),
        "last_report",
    )


def all_healthy(status: DataFrame) -> DataFrame:
    """One row: true iff every source is healthy and running; true when there is none."""
    return status.agg(F.coalesce(F.bool_and(F.col("healthy") & F.col("running")), F.lit(True)).alias("all_healthy"))


def _seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def eps_violations(
    df: DataFrame,
    limits: DataFrame,
    ts_col: str = "ts",
    per: str = "1 second",
    watermark: str | None = "1 minute",
) -> DataFrame:
    """Windows in which a tenant exceeds its event-rate limit (E5).

    Count per tenant and ``per`` window; the allowance is ``max_eps`` x the
    window's seconds. Output: tenant_id, window_start, n_events, allowed,
    overage. The limits are joined before the aggregation (on a stream they
    have to be, and Spark broadcasts them as long as they are small); a
    stream gets a watermark (late rows past it are dropped and counted in
    the query progress, see ``signals.streaming.listener.late_rows``).
    """
    lim = limits.select(F.col("tenant_id").alias("__lt"), "max_eps")
    j = df.join(lim, F.col("tenant_id") == F.col("__lt"))
    d, ts = event_time_for(j, ts_col, watermark)
    c = d.groupBy("tenant_id", "max_eps", F.window(ts, per).alias("w")).agg(F.count(F.lit(1)).alias("n_events"))
    allowed = F.col("max_eps") * _seconds(F.col("w.start"), F.col("w.end"))
    start = bound_of(F.col("w.start"), j, ts_col, watermark)
    out = c.select("tenant_id", start.alias("window_start"), "n_events", allowed.alias("allowed"))
    return out.filter(F.col("n_events") > F.col("allowed")).withColumn("overage", F.col("n_events") - F.col("allowed"))
