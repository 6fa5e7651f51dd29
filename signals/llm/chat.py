"""Chat formatting with collapse of cumulative snapshots. DataFrame functions only.

Logs often hold a conversation several times, each snapshot one turn longer.
Every turn gets the rolling hash of the conversation up to it: the XOR of
128-bit hashes of (position, role, text). A conversation whose full hash is
some other's hash at an earlier turn is a prefix of it; an anti-join on
distinct hashes drops it, and of equal conversations the least id stays.
Only what remains is rendered, a row per turn.

Positions and rolling hashes are built in two levels, within runs of
``SPAN`` turn numbers and over the runs of a conversation, on rows without
text, so that a conversation with very many turns is no single task's work. A
common first turn is one row after the distinct count's partial aggregation.

Defined results: turns are ordered by number (null last), then by the hash of
role and text; repeated rows are turns of their own; a null role or text
renders as empty and differs from an empty one when conversations are compared;
a null id is one conversation; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 256

#: The marks around a turn's role and text.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _hash(seed: int, *more: Column) -> Column:
    parts = [F.col("role"), F.col("text")]
    return F.xxhash64(F.lit(seed), *[x for p in parts for x in (p.isNull(), F.coalesce(p, F.lit("")))], *more)


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, n turns, h, g): the rolling hash at every turn."""
    run = Window.partitionBy("conv_id", "run")
    runs = Window.partitionBy("conv_id").orderBy(F.col("run").asc_nulls_last())
    before = runs.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    rows = turns.select("conv_id", "turn", F.floor(F.col("turn") / SPAN).alias("run"), _hash(1).alias("a"), _hash(2).alias("b"))
    rows = rows.withColumn("at", F.row_number().over(run.orderBy(F.col("turn").asc_nulls_last(), "a", "b")))

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({"conv_id": "c", "run": "r"})
        return left.join(right, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("run").eqNullSafe(F.col("r"))).drop("c", "r")

    sizes = rows.groupBy("conv_id", "run").agg(F.count("*").alias("size"))
    starts = sizes.select("conv_id", "run", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"), F.sum("size").over(whole).alias("n"))
    placed = joined(rows, starts).withColumn("pos", F.col("start") + F.col("at"))
    placed = placed.select(
        "conv_id", "run", "at", "pos", "n", F.xxhash64(F.lit(3), "pos", "a", "b").alias("x"), F.xxhash64(F.lit(4), "pos", "b", "a").alias("y")
    )
    sums = placed.groupBy("conv_id", "run").agg(F.bit_xor("x").alias("x0"), F.bit_xor("y").alias("y0"))
    carried = sums.select(
        "conv_id", "run", F.coalesce(F.bit_xor("x0").over(before), F.lit(0)).alias("cx"), F.coalesce(F.bit_xor("y0").over(before), F.lit(0)).alias("cy")
    )
    upto = run.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return joined(placed, carried).select(
        "conv_id",
        "pos",
        "n",
        F.col("cx").bitwiseXOR(F.bit_xor("x").over(upto)).alias("h"),
        F.col("cy").bitwiseXOR(F.bit_xor("y").over(upto)).alias("g"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies) of the conversations that prefix no longer one."""
    hashes = prefix_hashes(turns)
    full = hashes.where("pos = n").groupBy("pos", "h", "g").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    inner = hashes.where("pos < n").select("pos", "h", "g").distinct()
    return full.join(inner, ["pos", "h", "g"], "left_anti").select("conv_id", F.col("pos").alias("n_turns"), "copies")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(MIDDLE), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def chat_format(turns: DataFrame) -> DataFrame:
    """Every turn of the maximal conversations, rendered: (conv_id, turn, rendered, n_turns, copies)."""
    kept = maximal(turns).withColumnRenamed("conv_id", "kept_id")
    return (
        turns.select("conv_id", "turn", "role", "text")
        .join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")))
        .select("conv_id", "turn", rendered(F.col("role"), F.col("text")).alias("rendered"), "n_turns", "copies")
    )
