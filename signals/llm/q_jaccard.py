"""op9: the classes of linked documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signals.llm.common import documents
from signals.llm.jaccard import link_classes
from signals.llm.registry import register


@register("op9_jaccard")
def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_classes(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")
