"""A corpus pipeline of the training-data operators.

Each stage takes all documents that its predecessor kept, written as Parquet
and read again, and returns the columns of ``documents``; the last one adds
the token ids.

Defined results: a null or empty text fails the quality rules, so it goes in
the first stage, as do texts of very few words; of rows with equal or linked
texts the one with the least id stays, equal rows count once; very long texts
are treated whole; an empty table gives an empty result with all columns; other
columns go through unchanged, whatever their names, but for ``ids``,
``n_tokens`` and ``decodes`` in the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.llm import jaccard, mixing, pii, quality_rules, sentencepieces
from signals.llm.common import stored

TOKENIZER = "piece_bpe_32k.model"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.keep_good(docs)


def one_per_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each class of linked shingle sets."""
    return jaccard.one_of_each(docs)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the text."""
    clean = pii.redact(docs, pii.fit(docs))
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's budget takes it."""
    return mixing.mixed(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns with the ids, their number, and whether they decode to the text (columns of these names are replaced)."""
    import public_tokenizers

    path = public_tokenizers.path(TOKENIZER)
    coded = sentencepieces.encode_decode(docs, path)
    same = F.coalesce(F.col("decoded") == F.coalesce("text", F.lit("")), F.lit(False))
    kept = [c for c in docs.columns if c not in ("ids", "n_tokens", "decodes")]
    return coded.select(*kept, "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("decodes"))


STAGES = [
    ("quality_rules", good_quality),
    ("ngram_jaccard", one_per_class),
    ("pii", without_pii),
    ("mixing", mixed_sources),
    ("sentencepiece", tokenized),
]

#: SQL has no form of the tagger's and the tokenizer's stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
