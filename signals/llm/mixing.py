"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a budget of words. Whole passes over the source are taken as
often as they fit. For what remains, documents are counted by exact length; an
even share of each length is taken, then a bounded-knapsack dynamic program
over the leftover counts picks how many more of each length fill the rest, so
the words taken meet the budget to the word wherever the lengths allow it. Of
each (source, length) the documents with the least seeded hashes are taken.

Only one row per source reaches the driver (``MAX_SOURCES`` at most, else an
error); a knapsack task gets one row per length of one source, never documents.
Documents are ranked by range partitions, so a hot source or a hot length is
spread over many tasks.

Defined results: sources in code point order, null last, weigh ``weights``
repeating; a null text has size 0; documents of size 0 never count as taken
words; rows repeated in every column that is used are interchangeable; an empty
table gives an empty result; columns named as the results are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.llm.common import aside, n_words, ranked

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
MAX_SOURCES = 100_000
#: Words that the dynamic program fills, or twice the longest document left if that is more; larger remainders are first cut down by whole documents.
WINDOW = 1 << 16


def targets(sizes: list[int], weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> list[float]:
    """Budgets of sources in order: shares of all words by weight, at most ``max_repeat`` times a source, excess reshared."""
    w = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    out: dict[int, float] = {}
    free = [i for i, s in enumerate(sizes) if s > 0]
    out.update({i: 0.0 for i, s in enumerate(sizes) if s <= 0})
    while free:
        rest = sum(sizes) - sum(out.values())
        unit = rest / sum(w[i] for i in free)
        over = [i for i in free if unit * w[i] > max_repeat * sizes[i]]
        if not over:
            out.update({i: unit * w[i] for i in free})
            break
        out.update({i: float(max_repeat * sizes[i]) for i in over})
        free = [i for i in free if i not in out]
    return [out[i] for i in range(len(sizes))]


def fill(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, the even share at least, so that their words come nearest to ``budget``."""
    total = int((lengths * counts).sum())
    take = np.zeros(len(lengths), np.int64)
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    take = counts * budget // total if total < 2**31 else np.array([int(c) * budget // total for c in counts], np.int64)
    left, rest = counts - take, budget - int((lengths * take).sum())
    order = [i for i in np.argsort(-lengths, kind="stable") if lengths[i] > 0]
    longest = max((int(lengths[i]) for i in order if left[i] > 0), default=0)
    window = max(WINDOW, 2 * longest)  # so wide that a rest beyond it always has room for a whole document
    for i in order:  # whole documents, longest first, until the rest fits the program's window
        n = min(int(left[i]), max(0, rest - window // 2) // int(lengths[i]))
        take[i], left[i], rest = take[i] + n, left[i] - n, rest - n * int(lengths[i])
    room = 2 * rest  # a sum beyond it is farther off than none
    mask = (1 << (room + 1)) - 1
    reach, items = 1, []
    first = np.zeros(room + 1, np.int32)  # the item that reached each sum first; what it was added to was reached before
    for i in reversed(order):  # shortest first; counts split into powers of two
        n, size = min(int(left[i]), room // int(lengths[i])), 1
        while n > 0 and not reach >> rest & 1:
            size = min(size, n)
            new = reach << (size * int(lengths[i])) & mask & ~reach
            if new:
                bits = np.frombuffer(new.to_bytes(room // 8 + 1, "little"), np.uint8)
                at8 = np.flatnonzero(bits)
                rows, cols = np.nonzero(np.unpackbits(bits[at8], bitorder="little").reshape(-1, 8))
                first[at8[rows] * 8 + cols] = len(items)
                reach |= new
            items.append((i, size))
            n, size = n - size, size * 2
    under = (reach & ((1 << (rest + 1)) - 1)).bit_length() - 1
    over = reach >> rest
    above = rest + (over & -over).bit_length() - 1 if over else room + 1
    at = under if rest - under <= above - rest else above
    while at > 0:
        i, size = items[first[at]]
        take[i] += size
        at -= size * int(lengths[i])
    return take


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    """For one source's lengths: copies of every document, how many get one more, and where each length starts in the ranks."""
    pdf = pdf.sort_values("size", ignore_index=True)
    lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    total, target = int((lengths * counts).sum()), float(pdf["target"].iloc[0])
    passes = min(int(target // total), MAX_REPEAT) if total else 0
    extra = fill(lengths, counts, round(target - passes * total) if passes < MAX_REPEAT else 0)
    start = int(pdf["first"].iloc[0]) + np.concatenate([[0], np.cumsum(counts)[:-1]])
    return pd.DataFrame({"__source": pdf["source"], "__size": lengths, "source_size": total, "target": target, "__passes": passes, "__extra": extra, "__start": start})


def mix(docs: DataFrame, size: Column | None = None, source: str = "source", doc_id: str = "doc_id", seed: int = 8, weights=WEIGHTS) -> DataFrame:
    """Add to every document its ``size``, ``source_size``, ``target`` and ``copies``, how often the mix takes it."""
    spark = docs.sparkSession
    docs = docs.drop("source_size", "target", "copies").withColumn("size", n_words(F.col("text")) if size is None else size)
    order = [F.col(source).asc_nulls_last(), F.col("size"), F.xxhash64(F.lit(seed), F.col(doc_id)), F.col(doc_id)]
    rows = ranked(docs, order, "__rank")
    lengths = rows.groupBy(F.col(source).alias("source"), "size").agg(F.count("*").alias("n"))
    sources = lengths.groupBy("source").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("words"))
    known = sorted(sources.limit(MAX_SOURCES + 1).collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
    if len(known) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    budgets, first, table = targets([r["words"] for r in known], weights), 0, []
    for r, t in zip(known, budgets):
        table.append((r["source"], t, first))
        first += r["n"]
    kind = docs.schema[source].dataType.simpleString()
    budget = spark.createDataFrame(table, f"b_source {kind}, target double, first long")  # at most MAX_SOURCES rows
    plan = (
        lengths.join(F.broadcast(budget), F.col("source").eqNullSafe(F.col("b_source")))
        .select("source", "size", "n", "target", "first")
        .groupBy("source")
        .applyInPandas(_plan, f"__source {kind}, __size long, source_size long, target double, __passes long, __extra long, __start long")
    )
    chosen = rows.join(plan, F.col(source).eqNullSafe(F.col("__source")) & (F.col("size") == F.col("__size")))
    one_more = F.when(F.col("__rank") - F.col("__start") < F.col("__extra"), 1).otherwise(0)
    return chosen.withColumn("copies", F.col("__passes") + one_more).select(*docs.columns, "source_size", "target", "copies")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs`` only, whatever their names."""
    own, moved = aside(docs, ("size", "source_size", "target", "copies"))
    plan = mix(own, **options)
    copies = plan.withColumn("__copy", F.explode(F.expr("array_repeat(0, cast(copies AS int))")))
    return copies.select(*[F.col(moved.get(c, c)).alias(c) for c in docs.columns])
