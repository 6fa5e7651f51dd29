"""Tenant stamp (B1) and envelope schemas for collected events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_EVENT = T.StructType(
    [
        T.StructField("raw_data", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("file_path", T.StringType()),
    ]
)

REMOTE_ADDR = T.StructType([T.StructField("ip", T.StringType()), T.StructField("port", T.IntegerType())])

DATAGRAM_EVENT = T.StructType(
    [
        T.StructField("raw_data", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("received_at", T.TimestampType()),
        T.StructField("seq", T.LongType()),
        T.StructField("remote_addr", REMOTE_ADDR),
    ]
)


def stamp(df: DataFrame, tenant_id: str, source_id: str) -> DataFrame:
    """Set ``tenant_id`` and ``source_id`` on every row, overwriting existing values (B1).

    All other columns are kept as they are.
    """
    return df.withColumns({"tenant_id": F.lit(tenant_id), "source_id": F.lit(source_id)})


def combine_envelopes(*dfs: DataFrame) -> DataFrame:
    """One wide nullable envelope from file and datagram events."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
