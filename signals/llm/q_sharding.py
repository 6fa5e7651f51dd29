"""op1: all documents in shards 0 to 7."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.llm.common import documents
from signals.llm.registry import register
from signals.llm.sharding import shard


def pieces(text: Column) -> Column:
    """Hashes of all lines that aren't empty; of a text in one line, of its sentences too."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x != "")
    sentences = F.filter(F.split(text, "(?<=[.!?])[\\x20\\n]+", -1), lambda x: x != "")
    return F.transform(F.when(F.size(lines) == 1, F.concat(lines, sentences)).otherwise(lines), lambda x: F.xxhash64(x))


@register("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hub"),
        pieces(text).alias("pieces"),  # near copies share most of them
    )
    placed = shard(docs, ["text_hub", "pieces"], n_shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
