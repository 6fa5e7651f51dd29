"""op13: a toxicity score for every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.llm.common import crc_mod, documents
from signals.llm.registry import register
from signals.llm.toxicity import fit, scored


@register("op13_toxicity")
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = fit(docs, labels, ~held_out)
    return scored(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
