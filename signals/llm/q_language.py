"""op10: the language of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.llm.common import crc_mod, documents
from signals.llm.language import fit, identify
from signals.llm.registry import register


@register("op10_language")
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = fit(docs.select("doc_id", "text", "lang"), ~held_out)
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
