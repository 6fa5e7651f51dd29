"""op8: the mix of all documents by source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.llm.common import documents, n_words
from signals.llm.mixing import mix
from signals.llm.registry import register


@register("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", n_words(F.col("text")).alias("size"))
    plan = mix(docs, size=F.col("size"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
