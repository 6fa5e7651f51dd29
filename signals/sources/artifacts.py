"""Schema artifacts as XML documents (A7 reader, A8 writer).

One document per (tenant, log type) and run, written with ``to_xml`` and read
back with Spark's XML source. Spark names its part files itself, so the
artifact name (``schema_{type}_{yyyyMMdd_HHmmss}.xml``) is the value of the
``artifact`` partition directory below ``tenant_id=...``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signals.operators.schema import artifact_name

FIELD = T.StructType(
    [
        T.StructField("_name", T.StringType()),
        T.StructField("_type", T.StringType()),
        T.StructField("_confidence", T.StringType()),
    ]
)
LOG_SCHEMA = T.StructType(
    [
        T.StructField("_tenant", T.StringType()),
        T.StructField("_type", T.StringType()),
        T.StructField("Field", T.ArrayType(FIELD)),
    ]
)
# Attribute defaults when a Field lacks them.
DEFAULT_NAME, DEFAULT_TYPE, DEFAULT_CONFIDENCE = "", "string", "100%"


def schema_documents(catalog: DataFrame, run_time: Column | None = None, group: Sequence[str] = ("tenant_id", "log_type")) -> DataFrame:
    """One XML document per (tenant, log type): (tenant_id, log_type, artifact, xml).

    Fields keep their ``pos`` order. The per-schema field list is tiny (one
    entry per key), so gathering it per group is bounded.
    """
    rt = run_time if run_time is not None else F.current_timestamp()
    field = F.when(F.col("name").isNotNull(), F.struct("pos", "name", "type", "confidence"))  # an emptied schema has none
    g = catalog.groupBy(*group).agg(F.array_sort(F.collect_list(field)).alias("__f"))
    doc = F.struct(
        F.col("tenant_id").alias("_tenant"),
        F.col("log_type").alias("_type"),
        F.transform(
            "__f", lambda f: F.struct(f["name"].alias("_name"), f["type"].alias("_type"), f["confidence"].alias("_confidence"))
        ).alias("Field"),
    )
    return g.select(
        *group,
        artifact_name(F.col("log_type"), rt).alias("artifact"),
        F.to_xml(doc, {"rowTag": "LogSchema"}).alias("xml"),
    )


def write_schema_artifacts(catalog: DataFrame, root: str, run_time: Column | None = None) -> DataFrame:
    """Write the documents below ``{root}/tenant_id=<t>/artifact=<name>/`` (A8); returns them."""
    docs = schema_documents(catalog, run_time)
    docs.select("tenant_id", "artifact", "xml").write.mode("append").partitionBy("tenant_id", "artifact").text(root)
    return docs


def read_schema_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """Flatten artifacts to (tenant, log_type, artifact, file_name, pos, name, type, confidence).

    ``tenant``/``log_type`` come from the document's attributes. Missing
    attributes default to name '', type 'string', confidence '100%'; a
    document without fields yields one row with null field columns.
    """
    reader = spark.read.format("xml").schema(LOG_SCHEMA).option("rowTag", "LogSchema").option("recursiveFileLookup", "false")
    cols = [c for c in ("tenant_id", "artifact") if c in reader.load(path).columns]
    # ids are strings, also those that look like numbers
    reader = reader.schema(T.StructType([*LOG_SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in cols]]))
    df = reader.load(path).withColumn("file_name", F.substring_index(F.col("_metadata.file_path"), "/", -1))
    x = df.select(
        F.col("_tenant").alias("tenant"),
        F.col("_type").alias("log_type"),
        *cols,
        "file_name",
        F.posexplode_outer("Field").alias("pos", "__f"),
    )
    has = F.col("__f").isNotNull()
    return x.select(
        "tenant",
        "log_type",
        *cols,
        "file_name",
        F.col("pos").cast("int").alias("pos"),
        F.when(has, F.coalesce(F.col("__f._name"), F.lit(DEFAULT_NAME))).alias("name"),
        F.when(has, F.coalesce(F.col("__f._type"), F.lit(DEFAULT_TYPE))).alias("type"),
        F.when(has, F.coalesce(F.col("__f._confidence"), F.lit(DEFAULT_CONFIDENCE))).alias("confidence"),
    )


def schema_fields(artifacts: DataFrame, tenant: str, log_type: str, artifact: str | None = None) -> list[tuple[str, str]]:
    """The (name, type) list of one schema for ``apply_schema``.

    A schema is configuration of bounded size (one entry per field), so this
    collects only that list; the newest artifact is used unless one is named.
    """
    a = artifacts.filter((F.col("tenant") == tenant) & (F.col("log_type") == log_type))
    # flat folders have no partition by artifact: there the file's name is the artifact's
    name = F.col("artifact" if "artifact" in artifacts.columns else "file_name")
    if artifact is not None:
        a = a.filter(name == artifact)
    else:
        latest = a.agg(F.max(name).alias("m")).first()
        if latest is None or latest["m"] is None:
            return []
        a = a.filter(name == latest["m"])
    return [(r["name"], r["type"]) for r in a.orderBy("pos").select("name", "type").collect()]
