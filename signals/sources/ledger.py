"""Offset ledger (A10): last committed offset per ``tenant::source``.

Recovery itself is a streaming checkpoint; this is the reporting view. A
record without an offset does not commit, and the *last* offset by arrival
wins, not the largest.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def offset_ledger(
    df: DataFrame,
    seq_col: str = "seq",
    offset_col: str = "offset",
    key: Sequence[str] = ("tenant_id", "source_id"),
) -> DataFrame:
    """(key..., ledger_key 'tenant::source', offset) with the offset of the last committing record.

    One partial aggregation (``max_by`` merges per map task before the shuffle).
    """
    k = list(key)
    committed = df.filter(F.col(offset_col).isNotNull())
    g = committed.groupBy(*k).agg(F.max_by(F.col(offset_col), F.col(seq_col)).alias(offset_col))
    return g.withColumn("ledger_key", F.concat_ws("::", *[F.col(c) for c in k]))


def get_offset(ledger: DataFrame, tenant_id: str, source_id: str, offset_col: str = "offset") -> DataFrame:
    """The ledger row of one source (empty when unknown)."""
    return ledger.filter((F.col("tenant_id") == tenant_id) & (F.col("source_id") == source_id)).select(offset_col)
