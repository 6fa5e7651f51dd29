"""op5: personal data in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.llm.common import documents
from signals.llm.pii import find, fit
from signals.llm.registry import register
from signals.llm.tagger import KINDS


@register("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = find(docs, fit(docs)).drop("text")
    of_kind = lambda k: F.size(F.filter("base", lambda s: s.startswith(k + ":"))).cast("long")
    return found.select(
        "doc_id",
        *[of_kind(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.concat_ws(",", "base"), 256).alias("base_sha256"),
        F.concat_ws(",", "spans").alias("spans"),
    )
