"""Bounded "latest events" views.

The reference keeps per-source and global rings of 5,000 events and serves
the newest ``limit`` of them. Here the same views are top-k queries over a
log table: ``orderBy().limit()`` becomes TakeOrderedAndProject (a per-partition
top-k, then a merge of k rows per partition) and ``row_number() <= k`` gets a
partial window group limit before its shuffle, so a hot source ships at most
k rows per map task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signals.operators.sequence import MAX_ROWS, along_groups, ordered_groups

RING_CAPACITY = 5000
DEFAULT_LIMIT = 50
SOURCE_KEY = ("tenant_id", "source_id")


def _order(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def check_limit(limit: int, maximum: int = RING_CAPACITY) -> int:
    """1 <= limit <= 5000, as the viewer API enforces. Zero is refused."""
    if not isinstance(limit, int) or isinstance(limit, bool) or limit < 1 or limit > maximum:
        raise ValueError(f"limit must be between 1 and {maximum}, got {limit!r}")
    return limit


def _desc(order: list[str]) -> list[Column]:
    return [F.col(c).desc() for c in order]


def latest_global(df: DataFrame, order: str | Sequence[str], limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The newest ``limit`` rows across all sources, returned oldest first (B2)."""
    o = _order(order)
    check_limit(limit)
    return df.orderBy(*_desc(o)).limit(limit).orderBy(*o)


def _group_limit_threshold(df: DataFrame) -> int:
    try:
        return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    except Exception:  # pragma: no cover
        return 1000


def _bucket_for(df: DataFrame, col: str, bucket):
    """Default bucket for the order column: minutes for times, 4096 for integer ids; None otherwise."""
    if bucket is not None:
        return bucket
    t = df.schema[col].dataType.typeName()
    if t in ("timestamp", "timestamp_ntz"):
        return "minute"
    if t in ("long", "integer", "short", "byte"):
        return 4096
    return None


def latest_per_source(
    df: DataFrame,
    order: str | Sequence[str],
    limit: int = DEFAULT_LIMIT,
    key: Sequence[str] = SOURCE_KEY,
    rank_col: str = "rn",
    bucket: str | float | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """The newest ``limit`` rows of every (tenant, source), all keys at once.

    ``rank_col`` is 1 for the newest row of the key. Up to Spark's window
    group limit threshold (1000 by default) ``row_number() <= limit`` gets a
    partial top-k before the shuffle. Above it (rings of 5,000) the order
    column is cut into buckets, and large buckets at ``max_rows`` (see
    ``sequence.ordered_groups``): a running sum of their counts from the newest
    one finds those that overlap the newest ``limit`` rows, and only rows in
    them are ranked, so a source holding a third of all rows, or a burst of
    equal times, ranks about ``limit`` + ``max_rows`` rows, not all of them.
    """
    o = _order(order)
    check_limit(limit)
    w = Window.partitionBy(*key).orderBy(*_desc(o))
    b = _bucket_for(df, o[0], bucket)
    if limit > _group_limit_threshold(df) and b is None:
        raise ValueError(f"a ring of {limit} rows needs a time or integer as its first order column, or a bucket width")
    if limit <= _group_limit_threshold(df):
        return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= limit)
    d, counts = ordered_groups(df, list(key), o, b, max_rows)
    newer = F.coalesce(F.sum("__cnt").over(along_groups(key, descending=True)), F.lit(0))
    keep = counts.withColumn("__newer", newer).filter(F.col("__newer") < limit)
    cand = d.join(keep.select(F.col("__g").alias("__kg")), F.col("__g") == F.col("__kg"), "left_semi")
    ranked = cand.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= limit)
    return ranked.drop("__g")


def retain_latest(
    df: DataFrame,
    order: str | Sequence[str],
    id_col: str,
    per_source: int = RING_CAPACITY,
    total: int = RING_CAPACITY,
    key: Sequence[str] = SOURCE_KEY,
    bucket: str | float | None = None,
) -> DataFrame:
    """Rows still held by the rings: newest ``per_source`` per source or newest ``total`` overall.

    The two rings are separate, so a noisy source can evict others from the
    global ring only. Adds ``in_source_ring`` and ``in_global_ring``. Each ring
    is its own bounded top-k; they are merged on ``id_col`` (at most
    sources x per_source + total rows reach that shuffle).
    """
    o = _order(order)
    check_limit(per_source, maximum=10**7)
    check_limit(total, maximum=10**7)
    src = latest_per_source(df, o, per_source, key, "__rn", bucket).drop("__rn").withColumn("__src", F.lit(True))
    glob = df.orderBy(*_desc(o)).limit(total).withColumn("__glob", F.lit(True))
    both = src.unionByName(glob, allowMissingColumns=True)
    cols = [c for c in df.columns if c != id_col]
    merged = both.groupBy(id_col).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in cols],
        F.coalesce(F.max("__src"), F.lit(False)).alias("in_source_ring"),
        F.coalesce(F.max("__glob"), F.lit(False)).alias("in_global_ring"),
    )
    return merged.select(*df.columns, "in_source_ring", "in_global_ring")


def latest_view(
    df: DataFrame,
    order: str | Sequence[str],
    tenant_id: str,
    source_id: str,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """What the log viewer shows: the newest ``limit`` rows globally, then one source.

    The filter runs after the limit on purpose; a quiet source can show
    nothing. Catalyst never moves a filter below a limit.
    """
    return latest_global(df, order, limit).filter((F.col("tenant_id") == tenant_id) & (F.col("source_id") == source_id))
