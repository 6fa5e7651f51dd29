"""Tenant zone layout (A6): one folder per zone, Hive partitions by tenant (and date).

The reference keeps ``<tenant>/data/raw``, ``data/processed``, ``models``,
``artifacts/parsers``, ``metrics``, ``config`` per tenant. Here a zone is a
folder partitioned by ``tenant_id``, so a tenant's reads prune to its folders.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The per-tenant zones.
ZONES = ("data/raw", "data/processed", "models", "artifacts/parsers", "metrics", "config")


def _check(zone: str) -> str:
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}; one of {ZONES}")
    return zone


def zone_root(root: str, zone: str) -> str:
    return f"{root.rstrip('/')}/{_check(zone)}"


def zone_path(root: str, tenant_id: str, zone: str) -> str:
    """Folder holding one tenant's part of a zone."""
    return f"{zone_root(root, zone)}/tenant_id={tenant_id}"


def write_zone(
    df: DataFrame,
    root: str,
    zone: str,
    date_col: str | None = None,
    extra_partitions: Sequence[str] = (),
    fmt: str = "parquet",
    mode: str = "append",
    rebalance: bool = True,
) -> None:
    """Write rows to a zone, partitioned by ``tenant_id`` (then ``dt`` from ``date_col``).

    With ``rebalance`` the rows are shuffled by the partition columns under
    Spark's REBALANCE hint: adaptive execution splits a hot tenant-day over
    several tasks and merges small ones, so each folder gets a few
    right-sized files instead of one file per writing task.
    """
    parts = ["tenant_id"]
    if date_col:
        df = df.withColumn("dt", F.to_date(F.col(date_col)))
        parts.append("dt")
    parts += list(extra_partitions)
    if rebalance:
        df = df.hint("rebalance", *parts)
    df.write.mode(mode).partitionBy(*parts).format(fmt).save(zone_root(root, zone))


def with_string_partitions(spark: SparkSession, reader, path: str, columns: Sequence[str]) -> DataFrame:
    """Load a partitioned folder with these partition columns as strings.

    Spark infers partition types from the folder names, which would turn an
    id like '0042' into the number 42. The schema is read once, then given
    with the ids as strings.
    """
    inferred = reader.load(path).schema
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in columns else f for f in inferred.fields])
    return reader.schema(schema).load(path)


def read_zone(
    spark: SparkSession,
    root: str,
    zone: str,
    tenant_id: str | None = None,
    fmt: str = "parquet",
    layout: str = "partitioned",
) -> DataFrame:
    """Read a zone; a tenant filter reads only that tenant's folders.

    ``layout="partitioned"`` (as ``write_zone`` writes): the tenant filter is
    a partition filter. ``layout="tenant_dirs"``: one folder per tenant,
    ``{root}/<tenant>/<zone>`` as the reference keeps them; ``tenant_id`` is
    taken from the path (and a tenant filter reads just its folder).
    """
    if layout == "partitioned":
        df = with_string_partitions(spark, spark.read.format(fmt), zone_root(root, zone), ("tenant_id",))
        if tenant_id is not None:
            df = df.filter(F.col("tenant_id") == F.lit(tenant_id))
        return df
    if layout == "tenant_dirs":
        base = root.rstrip("/")
        path = f"{base}/{tenant_id}/{_check(zone)}" if tenant_id is not None else f"{base}/*/{_check(zone)}"
        depth = len(zone.split("/"))
        df = spark.read.format(fmt).option("recursiveFileLookup", "true").load(path)
        parts = F.split(F.col("_metadata.file_path"), "/")
        # <root>/<tenant>/<zone...>/<file>: the tenant is the folder just above the zone path
        return df.withColumn("tenant_id", F.element_at(parts, -(depth + 2)))
    raise ValueError("layout must be 'partitioned' or 'tenant_dirs'")
