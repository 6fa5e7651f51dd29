"""Helpers shared by the operators: words, seeded hashes, stored intermediates and global ranks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signals.session import scratch_path

#: The white space that separates words (space and U+0009 to U+000D).
WORD_RE = "[^\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; null gives an empty array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD_RE), F.lit(0))


def n_words(text: Column) -> Column:
    """How many words a text has (null: 0), without building them: pieces between white space, less empty ends."""
    t = F.coalesce(text, F.lit(""))
    pieces = F.size(F.split(t, "[\\x20\\x09-\\x0D]+"))
    empty = F.when(t.rlike("^[\\x20\\x09-\\x0D]"), 1).otherwise(0) + F.when(t.rlike("[\\x20\\x09-\\x0D]\\z"), 1).otherwise(0)
    return F.when(t.rlike("[^\\x20\\x09-\\x0D]"), pieces - empty).otherwise(0).cast("long")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value``, which is evaluated once however often ``v`` is used."""
    return F.transform(F.array(value), body)[0]


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null id: the crc of an empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def stored(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later passes, retries and lost executors read the files and never the plan
    behind them, so a value that depends on the run (a partition's number) is fixed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(compression="zstd", **(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete what :func:`stored` wrote for ``df``, when nothing reads it any more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(conf).delete(p, True)


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add ``name``: each row's position from 0 in the total order ``order``, at any size.

    Rows are range-partitioned and sorted, so no task holds more than its
    share, also when one leading key has a third of the rows (give ``order`` a
    distinguishing last column). The position in the partition is stored; then
    one row per partition gives where each partition starts.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    rows = stored(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__at", at), name)
    part, pos = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part.alias("p")).agg(F.max(pos).alias("last")).collect()  # one row for each partition
    start, starts = 0, []
    for p, last in sorted((r["p"], r["last"]) for r in sizes):
        starts.append((p, start))
        start += last + 1
    table = spark.createDataFrame(starts, "__p long, __start long")
    return (
        rows.withColumn("__p", part)
        .join(F.broadcast(table), "__p")
        .withColumn(name, F.col("__start") + pos)
        .drop("__p", "__start", "__at")
    )


def aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns called as one of ``names`` renamed, and what they are called now."""
    moved = {c: f"__own_{c}" for c in df.columns if c in set(names)}
    return df.withColumnsRenamed(moved), moved


def add_columns(df: DataFrame, added: str, start, rows: int = 1024) -> DataFrame:
    """``df`` with the columns of the DDL ``added`` (replacing such names), computed from Arrow batches.

    ``start()`` runs once per task and gives a function from a record batch to
    the added columns' arrays, in order. Batches are cut to ``rows`` rows, which
    bounds what a task holds at a time.
    """
    fields = T.StructType.fromDDL(added).fields
    keep = [c for c in df.columns if c not in {f.name for f in fields}]
    schema = T.StructType([*df.select(*keep).schema.fields, *fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *work(batch)], names=schema.names)

    return df.mapInArrow(run, schema)
