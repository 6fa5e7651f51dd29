"""Log file source (A1) with line numbers and byte offsets (A3).

``read_logs`` reads text files with Spark's text source (files are split and
read in parallel; bad UTF-8 becomes U+FFFD). Line order inside a file is
recovered from the split a line came from (``_metadata.file_block_start``)
and the line's position in its scan task, where the rows of a split follow each
other in file order. Lines are shuffled once, by split, and numbered and their
bytes added up there by window functions; a row for each split then tells the
lines and bytes before it. Both sides read the same shuffle, so the text is
scanned once.
"""

from __future__ import annotations

import os
import uuid
from typing import Iterator, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signals.functions.text import decode_replace
from signals.session import local_path

#: Names of files that Spark's text source decompresses.
COMPRESSED = r"\.(gz|bz2|zst|lz4|snappy|deflate)$"

def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their byte length including the terminator (universal newlines).

    The text source splits at '\\n' only, so a '\\r' stays in the value: a
    trailing one makes the terminator '\\r\\n' (2 bytes) and an inner one ends
    a line of its own (1 byte). Lines without '\\r' are not split again. The
    last piece of a line takes the remainder of the line's raw byte length, so
    line ends are exact even when a bad byte was re-encoded by the split.
    """
    t = spark.read.option("lineSep", "\n").text(path)
    v = F.col("value")
    has_cr = F.instr(v, "\r") > 0
    crlf = has_cr & v.endswith("\r")  # the '\\r' of a '\\r\\n' ends the last piece
    split = F.split(v, "\r", -1)
    split = F.when(crlf, F.slice(split, 1, F.size(split) - 1)).otherwise(split)
    t = t.select(
        v,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("__blk"),
        F.col("_metadata.file_size").alias("__size"),
        F.when(has_cr, split).otherwise(F.array(v)).alias("__pieces"),
    )
    pieces, n = F.col("__pieces"), F.size("__pieces")
    # bytes of all pieces but the last, plus one '\\r' after each of them
    head = F.when(n > 1, F.octet_length(F.array_join(F.slice(pieces, 1, n - 1), "\r")) + 1).otherwise(0)
    x = t.select(
        "file_path", "__blk", "__size", n.alias("__n"),
        # the raw line's bytes plus its '\\n' (exact even where the split re-encoded bad bytes)
        (F.octet_length(v) + 1 - head).alias("__last_len"),
        F.posexplode(pieces).alias("__pi", "__piece"),
    )
    length = F.when(F.col("__pi") == F.col("__n") - 1, F.col("__last_len")).otherwise(F.octet_length(F.col("__piece")) + 1)
    return x.select(
        decode_replace(F.col("__piece")).alias("raw_data"),
        "file_path",
        "__blk",
        "__size",
        length.cast("long").alias("__len"),
    )


def read_logs(spark: SparkSession, path: str, with_offsets: bool = True) -> DataFrame:
    """One row per line: ``raw_data``, ``file_path`` and, with offsets, ``line_no`` and ``offset`` (A1, A3).

    ``line_no`` is 1-based within the file; ``offset`` is the byte position
    after the line and its terminator (``\\n``, ``\\r\\n`` or a lone ``\\r``), as a
    tail reader's ``tell()`` reports it. In compressed files it counts the
    bytes of the text, with a line break after every line.
    """
    if not with_offsets:
        return _lines(spark, path).select("raw_data", "file_path")
    # the position in the scan task is the same in a retried task, which reads the same splits
    lines = _lines(spark, path).withColumn("__at", F.monotonically_increasing_id())
    inside = Window.partitionBy("file_path", "__blk").orderBy("__at")
    local = lines.withColumns({"__idx": F.row_number().over(inside), "__cum": F.sum("__len").over(inside.rowsBetween(Window.unboundedPreceding, 0))})
    # the text counts as read here, too: with the same columns, this side takes the shuffle of the other
    totals = local.groupBy("file_path", "__blk", "__size").agg(
        F.max("__idx").alias("__n"), F.max("__cum").alias("__bytes"), F.count("raw_data").alias("__texts")
    )
    before = Window.partitionBy("file_path").orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.where("__texts >= 0").select(
        F.col("file_path").alias("__file"), F.col("__blk").alias("__split"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__lines_before"),
        F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__bytes_before"),
    )
    j = local.join(totals, (F.col("file_path") == F.col("__file")) & (F.col("__blk") == F.col("__split")))
    end = F.col("__bytes_before") + F.col("__cum")
    # the last line of a file without a final newline ends at the file size; a compressed file's size says nothing
    offset = F.when(F.col("file_path").rlike(COMPRESSED), end).otherwise(F.least(end, F.col("__size"))).cast("long")
    line = (F.col("__lines_before") + F.col("__idx")).cast("long")
    # an offset is never negative: the condition keeps the shuffled columns the same where only numbers are asked for
    return j.select("raw_data", "file_path", F.when(offset >= 0, line).alias("line_no"), offset.alias("offset"))


def with_byte_offset(spark: SparkSession, path: str) -> DataFrame:
    """Batch form of A3 over whole files: ``read_logs`` with ``line_no`` and ``offset``."""
    return read_logs(spark, path, with_offsets=True)


def stream_logs(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of rotated log files in ``directory`` (new files only; see ``tail_source`` for growing files)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    t = r.load(directory)
    return t.select(decode_replace(F.col("value")).alias("raw_data"), F.col("_metadata.file_path").alias("file_path"))


def write_lines(df: DataFrame, path: str, col: str = "raw_data", partition_by: list[str] | None = None) -> None:
    """Write a string column as newline-terminated text files."""
    w = df.select(col, *(partition_by or [])).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)


def write_files(df: DataFrame, path: str, name: str, order: Sequence[str], col: str = "raw_data") -> None:
    """Write a newline-terminated text file for each value of ``name``, its lines by ``order``.

    Spark's writer makes a folder for each value, which a reader then lists in
    a task of its own, and on the machines' file system Hadoop starts a
    ``chmod`` process for each file and its checksum where its native library
    is absent. There the tasks write the files themselves, all into one folder.
    A file gets its name when it is whole, so a repeated task replaces it by
    the same lines.
    """
    lines = df.repartition(name).sortWithinPartitions(name, *order)
    root = local_path(df.sparkSession, path)
    if root is None:
        lines.select(col, name).write.partitionBy(name).text(path)
        return

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        n, at, out, hidden = 0, None, None, None

        def close():
            out.close()
            os.replace(hidden, f"{root}/part-{'__HIVE_DEFAULT_PARTITION__' if at is None else quote(at, safe='')}.txt")

        for batch in batches:
            start = 0
            runs = pc.run_end_encode(batch.column(0))
            for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if out is None or value != at:
                    if out is not None:
                        close()
                    n, at, hidden = n + 1, value, f"{root}/.{uuid.uuid4().hex}"
                    out = open(hidden, "wb")
                held = batch.column(1).slice(start, end - start).to_pylist()
                out.write(b"\n".join([line or b"" for line in held]) + b"\n")
                start = end
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["files"])

    os.makedirs(root)
    lines.select(F.col(name).cast("string"), F.col(col).cast("binary")).mapInArrow(write, "files long").agg(F.sum("files")).first()
    open(f"{root}/_SUCCESS", "wb").close()
