"""op3: fingerprints of all documents and of their edited texts; every 50th id is searched against all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.llm.common import documents
from signals.llm.registry import register
from signals.llm.simhash import as_hex, with_edited, within_radius


@register("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = with_edited(documents(spark, sf_dir))
    asked = F.coalesce(F.col("doc_id") % 50 == 0, F.lit(False))
    near = within_radius(prints.where(asked), prints).groupBy("query").agg(F.sum("n").alias("n_near"))
    queries = prints.where(asked).join(near, F.col("fingerprint") == F.col("query")).drop("query")
    rest = prints.where(~asked).withColumn("n_near", F.lit(None).cast("long"))
    return queries.unionByName(rest).withColumns({c: as_hex(F.col(c)) for c in ("fingerprint", "edited_fingerprint")})
