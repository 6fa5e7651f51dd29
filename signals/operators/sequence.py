"""Per-key arrival counters without a single hot task.

``row_number()`` over ``partitionBy(key)`` puts every row of a key in one
task; with one source holding a third of all events that task would hold a
third of the data. Here the order is cut into groups:

1. rows per (key, time or value bucket) are counted (partial aggregation,
   small output); a bucket with more than ``max_rows`` rows is cut further, at
   boundaries taken from a hashed sample of its rows in the order itself, so
   that neither a burst nor equal times make a large group;
2. a running sum over each key's groups gives the offset of every group
   (one row per group, so even a hot key's window is small);
3. rows are numbered inside their group and the offset is added.

Steps 3 and the offset join share one hash partitioning on the group, so the
rows are shuffled once. The numbers don't depend on where the boundaries lie,
and the sample is drawn by a hash: no ``monotonically_increasing_id``, so a task
retried after an executor loss produces the same numbers.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIME_UNITS = ("second", "minute", "hour", "day")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_of(c: Column, bucket: str | float) -> Column:
    """Monotone bucket of the leading order column: a time unit or a numeric width."""
    if isinstance(bucket, str):
        if bucket not in TIME_UNITS:
            raise ValueError(f"bucket must be one of {TIME_UNITS} or a number")
        return F.date_trunc(bucket, c)
    return F.floor(c / F.lit(bucket))


#: Rows of a (key, bucket) beyond which it is cut, and boundaries that a bucket gets at most.
MAX_ROWS = 1 << 20
MOST_CUTS = 256
_SAMPLES = 32  # drawn for each boundary


def ordered_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    bucket: str | float,
    max_rows: int = MAX_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(rows with their group ``__g``, counts ``__cnt`` by ``__g``): groups of about ``max_rows`` at most, in order within a key.

    ``__g`` is a struct of the keys, the bucket ``__b`` and the part ``__s`` of
    a cut bucket. Rows equal in all of ``order`` stay together.
    """
    cols = [_c(o) for o in order]
    d = df.withColumn("__k", F.struct(*[F.col(k) for k in keys], bucket_of(cols[0], bucket).alias("__b")))
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(cols)])
    large = d.groupBy("__k").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max_rows)
    large = large.select(F.col("__k").alias("__lk"), "__n", F.least(F.ceil(F.col("__n") / max_rows), F.lit(MOST_CUTS)).alias("__cuts"))
    # where no bucket is large this side is empty, and adaptive execution drops the join
    seen = d.select("__k", place.alias("__o")).join(large, F.col("__k") == F.col("__lk"))
    every = F.greatest(F.floor(F.col("__n") / (F.col("__cuts") * _SAMPLES)), F.lit(1))
    drawn = seen.where(F.pmod(F.xxhash64("__o"), every) == 0).groupBy("__lk", "__cuts").agg(F.sort_array(F.collect_list("__o")).alias("__o"))
    step = F.greatest(F.floor(F.size("__o") / F.col("__cuts")), F.lit(1))
    cuts = drawn.select("__lk", F.filter("__o", lambda o, i: (i > 0) & (i % step == 0)).alias("__bounds"))
    part = F.coalesce(F.size(F.filter("__bounds", lambda b: b <= place)), F.lit(0))
    part = F.when(F.col("__bounds").isNull(), 0).otherwise(part)
    d = d.join(cuts, F.col("__k") == F.col("__lk"), "left")
    d = d.withColumn("__g", F.struct("__k.*", part.alias("__s"))).drop("__k", "__lk", "__bounds")
    return d, d.groupBy("__g").agg(F.count(F.lit(1)).alias("__cnt"))


def along_groups(keys: Sequence[str], descending: bool = False):
    """A window over the groups of a key that come before the current one."""
    at = [F.col("__g.__b"), F.col("__g.__s")]
    at = [c.desc_nulls_last() if descending else c.asc_nulls_first() for c in at]
    return Window.partitionBy(*[F.col(f"__g.{k}") for k in keys]).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)


def arrival_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    out: str = "seq",
    bucket: str | float = "minute",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add ``out`` = 1-based position of each row within its key, by ``order``.

    ``order`` should be a total order inside a key (end it with a unique id).
    ``bucket`` cuts the leading order column (a time unit, or a width for a
    numeric column), ``max_rows`` what is larger still (:func:`ordered_groups`).
    Null keys form their own group (the group column is a struct, and struct
    equality treats null fields as equal).
    """
    keys, cols = list(keys), [_c(o) for o in order]
    d, counts = ordered_groups(df, keys, order, bucket, max_rows)
    offsets = counts.select(F.col("__g").alias("__og"), F.coalesce(F.sum("__cnt").over(along_groups(keys)), F.lit(0)).alias("__base"))
    numbered = d.withColumn("__rn", F.row_number().over(Window.partitionBy("__g").orderBy(*cols)))
    joined = numbered.join(offsets, numbered["__g"] == offsets["__og"], "inner")
    return joined.withColumn(out, (F.col("__base") + F.col("__rn")).cast("bigint")).drop("__g", "__og", "__base", "__rn")
