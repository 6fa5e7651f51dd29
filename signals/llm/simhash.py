"""SimHash fingerprints and the search within a Hamming radius.

Terms are pairs of adjacent words (A-Z lower-cased; a single word is its own
term), weighted 1 + ln(frequency). Each term's 64-bit hash votes with its
weight for or against every bit; a bit is 1 if more weight is for it.

Search: 64 bits are cut into ``blocks``; two fingerprints within the radius
agree on at least ``blocks - radius`` of them. For each choice of that many
blocks a table is keyed by these bits (the blocks permuted to the front), and
tables are joined on their keys. A pair is reported by the first table that
holds it, so candidates are checked inside the join and listed once. Equal
fingerprints count as one row with a weight, so copies don't multiply.

Defined results: null and empty texts and texts without a word have
fingerprint 0; equal texts have equal fingerprints; repeated rows count each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.llm.common import add_columns, stored
from signals.llm.hashing import Powers, shingles, word_hashes

RADIUS = 3
BLOCKS = 5


def fingerprint(text: str | None, powers: Powers) -> int:
    """The 64 bits as a signed integer."""
    words = word_hashes((text or "").encode("utf-8", "replace"), powers)
    if not len(words):
        return 0
    terms, counts = np.unique(shingles(words, 2), return_counts=True)
    weights = (1.0 + np.log(counts)).astype(np.float32)
    bits = np.unpackbits(terms.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = weights @ bits.astype(np.float32)
    return int(np.packbits(votes * 2 > weights.sum() * (1 + 1e-6), bitorder="little").view(np.int64)[0])


def likeness(a: int, b: int) -> float:
    return 1.0 - ((a ^ b) & (1 << 64) - 1).bit_count() / 64


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of every row's text as a long."""

    def start():
        powers = Powers()
        return lambda batch: [pa.array([fingerprint(t, powers) for t in batch.column(text).to_pylist()], pa.int64())]

    return add_columns(docs, f"{out} long", start)


def block_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """The bits of each table's key, as signed integers."""
    ends = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << b for b in range(a, e)) for a, e in zip(ends, ends[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fingerprint, n): distinct fingerprints of ``prints`` within ``radius`` of each of ``queries``'.

    Both have a column ``fingerprint``; ``n`` is how many rows of ``prints`` have it.
    """
    masks = block_masks(radius, blocks)
    keys = F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key")
    left = queries.select("fingerprint").distinct().select(F.col("fingerprint").alias("query"), keys)
    right = prints.groupBy("fingerprint").agg(F.count("*").alias("n")).select("fingerprint", "n", keys).withColumnsRenamed({"t": "t2", "key": "key2"})
    apart = F.col("query").bitwiseXOR(F.col("fingerprint"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    on = (F.col("t") == F.col("t2")) & (F.col("key") == F.col("key2")) & (F.bit_count(apart) <= radius) & (first == F.col("t"))
    return left.join(right, on).select("query", "fingerprint", "n")


_FIELDS = "n_chars long, edited_sha256 string, fingerprint long, edited_fingerprint long, near_edited double, near_next double"


def _edited(text: str, own: int, following: str, its: int, powers: Powers) -> tuple:
    cut = len(text) // 3
    edited = text[: len(text) - cut] + following[:cut]
    e = fingerprint(edited, powers)
    return len(text), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), own, e, likeness(own, e), likeness(own, its)


def with_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, ...): each document's fingerprint against its edited text's and the next document's.

    The edited text has its last third replaced by the start of the next
    document in descending id (null last; after the last, the first). Texts are
    range-partitioned by id once and read in order; each partition's last
    document meets the next partition's first in a second, small step.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc()]
    ids = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = ids.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    schema = f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, {_FIELDS}, part int, edge int, text string"
    names = ["doc_id", *[f.split()[0] for f in _FIELDS.split(", ")], "part", "edge", "text"]
    blank = (None,) * 6

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, last, types = Powers(), None, None
        for batch in batches:
            out = []
            types = types or [batch.schema.field("doc_id").type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.string()]
            for i, t, p in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "part"))):
                own = fingerprint(t, powers)
                if last is None:
                    out.append((i, *blank, p, 1, t))
                else:
                    out.append((last[0], *_edited(last[1], last[3], t, own, powers), p, 0, None))
                last = (i, t, p, own)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), types)], names=names) if out else pa.RecordBatch.from_pylist([], schema=pa.schema(list(zip(names, types))))
        if last:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip((last[0], *blank, last[2], 2, last[1])), types)], names=names)

    done = stored(rows.mapInArrow(run, schema), "simhash")
    filled = sorted(r["part"] for r in done.where("edge = 1").select("part").collect())  # one for each partition
    follows = spark.createDataFrame(list(zip(filled, filled[1:] + filled[:1])), "part int, follower int")
    firsts = done.where("edge = 1").select(F.col("part").alias("follower"), F.col("text").alias("following"))
    edges = done.where("edge = 2").select("doc_id", "part", "text").join(F.broadcast(follows), "part").join(firsts, "follower")

    def start():
        powers = Powers()

        def work(batch: pa.RecordBatch):
            pairs = zip(batch.column("text").to_pylist(), batch.column("following").to_pylist())
            found = [_edited(t, fingerprint(t, powers), f, fingerprint(f, powers), powers) for t, f in pairs]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            return [pa.array([x[k] for x in found], kind) for k, kind in enumerate(kinds)]

        return work

    columns = names[:7]
    return done.where("edge = 0").select(*columns).unionByName(add_columns(edges, _FIELDS, start).select(*columns))


def as_hex(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))
