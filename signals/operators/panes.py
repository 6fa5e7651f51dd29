"""Sliding windows by panes.

A pane is the greatest common divisor of window size and slide, so every window
is a run of whole panes. Events are aggregated once per pane, whatever the
number of windows they fall into. A pane belongs to the windows that start in
``(pane - size, pane]``: it enters at one start and leaves at a later one. The
entering and leaving amounts, added up along the starts, give runs of starts
whose windows hold the same panes; only runs that pass the threshold are
written out, a row for each start.

Per key no more rows meet than there are starts in its time span, however many
events it has. Sums of floating-point values are taken over the panes of each
run instead, since adding and subtracting them would leave rounding behind.
"""

from __future__ import annotations

import math
import re
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signals.streaming.time import from_micros, to_micros

_UNITS = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}


def micros_of(interval: str) -> int:
    """Microseconds of an interval such as ``1 day`` or ``1 hour 30 minutes`` (no months: their length varies)."""
    parts = re.findall(r"(\d+)\s*([a-z]+?)s?(?=\s|\d|$)", interval.strip().lower().removeprefix("interval "))
    if not parts or any(u not in _UNITS for _, u in parts) or re.sub(r"\d+\s*[a-z]+|\s", "", interval.lower().removeprefix("interval ")):
        raise ValueError(f"not an interval of fixed length: {interval!r}")
    return sum(int(n) * _UNITS[u] for n, u in parts)


def pane_of(size: str, slide: str) -> str:
    """The pane of a sliding window, as an interval."""
    return f"{math.gcd(micros_of(size), micros_of(slide))} microseconds"


def placed(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """Add ``__pane``, ``__from`` and ``__to``: a pane's start, the first window start that holds it, the first one after.

    ``panes`` has a ``window`` column of the pane's size. All three are in microseconds.
    """
    long, step = micros_of(size), micros_of(slide)
    after = lambda x: x - F.pmod(x, F.lit(step)) + F.lit(step)  # noqa: E731  the first start later than x
    out = panes.withColumn("__pane", to_micros(F.col("window.start"), panes.schema["window"].dataType["start"].dataType))
    return out.withColumns({"__from": after(F.col("__pane") - F.lit(long)), "__to": after(F.col("__pane"))})


def first_seen(panes: DataFrame, by: Sequence[str]) -> DataFrame:
    """``__from`` moved behind the windows that an earlier pane of the same ``by`` covers already, for distinct counts."""
    before = F.lag("__to").over(Window.partitionBy(*by).orderBy("__pane"))
    return panes.withColumn("__from", F.greatest("__from", before)).where("__from < __to")


def runs(pieces: DataFrame, keys: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """(keys, __start, __next, weights): the sum of the pieces' weights at all window starts from __start to before __next."""
    both = pieces.select(*keys, F.col("__from").alias("__start"), *weights).unionByName(
        pieces.select(*keys, F.col("__to").alias("__start"), *[(-F.col(w)).alias(w) for w in weights])
    )
    changes = both.groupBy(*keys, "__start").agg(*[F.sum(w).alias(w) for w in weights])
    along = Window.partitionBy(*keys).orderBy("__start")
    total = {w: F.sum(w).over(along) for w in weights}
    return changes.withColumns(total | {"__next": F.lead("__start").over(along)}).where(F.col("__next").isNotNull())


def runs_of_sums(pieces: DataFrame, keys: Sequence[str], weight: str, size: str) -> DataFrame:
    """As :func:`runs` for one weight, which is added up anew over the panes of each run."""
    none = F.lit(None).cast(pieces.schema[weight].dataType)
    starts = pieces.select(*keys, F.explode(F.array("__from", "__to")).alias("__start")).distinct()
    rows = pieces.select(*keys, F.col("__pane").alias("__start"), weight, F.lit(False).alias("__mark")).unionByName(
        starts.select("*", none.alias(weight), F.lit(True).alias("__mark"))
    )
    along = Window.partitionBy(*keys).orderBy("__start")
    inside = rows.withColumn(weight, F.sum(weight).over(along.rangeBetween(0, micros_of(size) - 1))).where("__mark")
    return inside.withColumn("__next", F.lead("__start").over(along)).where(F.col("__next").isNotNull() & F.col(weight).isNotNull())


def windows_of(found: DataFrame, size: str, slide: str, like) -> DataFrame:
    """A row for each window start of the runs, with ``window_start`` and ``window_end`` of the type ``like``."""
    start = F.explode(F.sequence("__start", F.col("__next") - 1, F.lit(micros_of(slide))))
    out = found.withColumn("__start", start)
    bounds = {"window_start": F.col("__start"), "window_end": F.col("__start") + F.lit(micros_of(size))}
    return out.withColumns({k: from_micros(v, like) for k, v in bounds.items()}).drop("__start", "__next")


def is_exact(df: DataFrame, c: Column) -> bool:
    """Can sums of ``c`` be taken apart again without rounding?"""
    return df.select(c).schema[0].dataType.typeName() not in ("float", "double")
