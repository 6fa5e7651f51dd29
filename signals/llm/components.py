"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signals.llm.common import forget, stored


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, root) for every id in ``edges`` (a, b: long) but the roots: ``root`` is the least id reachable.

    Each round links a vertex's larger neighbours, then its smaller ones, to
    its least neighbour, until nothing changes. Minima are pre-aggregated; the
    joins back are equi-joins that adaptive execution splits at hot vertices.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name
    )
    seen = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), name)
        mark = after.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        forget(links)
        links = after
        if mark == seen:
            return links.select(F.col("u").alias("id"), F.col("v").alias("root"))
        seen = mark
