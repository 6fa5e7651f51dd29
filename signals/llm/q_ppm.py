"""op4: scores of all documents under a trie and a unigram model of the training documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.llm.common import crc_mod, documents
from signals.llm.ppm import score
from signals.llm.registry import register


@register("op4_ppm")
def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod(F.col("doc_id"), 10) == 0
    docs = documents(spark, sf_dir).select("doc_id", held_out.alias("held_out"), "text")
    return score(docs, ~F.col("held_out"))
