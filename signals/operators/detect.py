"""Detection (F1-F4): predicate rules, threshold rules, the SYN-flood preset, behaviour features.

Every function takes a batch or a streaming DataFrame. On a stream the event
time column gets a watermark (cast to TIMESTAMP first: watermarks reject
TIMESTAMP_NTZ). Distinct counts are exact on both: values are first grouped
with key and window, then counted. On a stream, distinct counts and sliding
windows are therefore two aggregations in a row, which Spark runs in append
mode; the rest runs in every output mode.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.operators import panes
from signals.streaming.time import bound_of, event_time_for


@dataclass(frozen=True)
class Rule:
    """A detection rule: a name, a SQL predicate over the event columns, a severity."""

    name: str
    predicate: str
    severity: str = "Minor"


# The rule names the detection API lists.
RULE_NAMES = ("BruteForce_Login", "TCP_SYN_Flood")


def detect_rules(df: DataFrame, rules: Sequence[Rule], rule_col: str = "rule", severity_col: str = "severity") -> DataFrame:
    """One output row per (event, matching rule) (F1).

    All predicates are evaluated in a single projection (one pass, no union
    per rule); a null predicate result counts as no match.
    """
    if not rules:
        raise ValueError("at least one rule is required")
    hits = F.array(
        *[
            F.when(F.expr(r.predicate), F.struct(F.lit(r.name).alias("r"), F.lit(r.severity).alias("s")))
            for r in rules
        ]
    )
    tmp = "__hit"
    return (
        df.withColumn(tmp, F.explode(F.filter(hits, lambda h: h.isNotNull())))
        .withColumn(rule_col, F.col(f"{tmp}.r"))
        .withColumn(severity_col, F.col(f"{tmp}.s"))
        .drop(tmp)
    )


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _windowed(df: DataFrame, ts_col: str, window: str, slide: str | None, watermark: str | None) -> tuple[DataFrame, Column]:
    """(df with its event time, its windows), or the panes of sliding windows."""
    df, ts = event_time_for(df, ts_col, watermark)
    if not slide or panes.micros_of(slide) == panes.micros_of(window):
        return df, F.window(ts, window)
    if panes.micros_of(slide) > panes.micros_of(window):
        raise ValueError("the slide is longer than the window")
    return df, F.window(ts, panes.pane_of(window, slide))


def _slides(window: str, slide: str | None) -> bool:
    return bool(slide) and panes.micros_of(slide) != panes.micros_of(window)


def _finish(agg: DataFrame, source: DataFrame, ts_col: str, watermark: str | None) -> DataFrame:
    start, end = (bound_of(F.col(f"window.{x}"), source, ts_col, watermark) for x in ("start", "end"))
    return agg.withColumn("window_start", start).withColumn("window_end", end).drop("window")


def detect_threshold(
    df: DataFrame,
    key: str | Sequence[str],
    ts_col: str,
    window: str,
    threshold: float,
    agg: str = "count",
    value_col: str | None = None,
    slide: str | None = None,
    out: str = "n",
    watermark: str | None = "1 hour",
) -> DataFrame:
    """Entity x time window whose aggregate reaches ``threshold`` (F2).

    ``agg`` is ``count``, ``sum`` or ``count_distinct`` (of ``value_col``).
    Output: key columns, ``window_start``, ``window_end``, ``out``.
    The aggregation is partial (map-side) before the shuffle, so a hot key
    sends one partial row per map task, not its events. Sliding windows are
    put together from panes (see ``panes``).

    Windows align to the epoch: on TIMESTAMP input in UTC, on
    TIMESTAMP_NTZ input in wall-clock time. Cast to TIMESTAMP_NTZ for days
    that start at local midnight in a non-UTC session (the flagship does).
    """
    if agg not in ("count", "sum", "count_distinct"):
        raise ValueError(f"unknown aggregate {agg!r}")
    keys = _keys(key)
    source = df
    df, w = _windowed(df, ts_col, window, slide, watermark)
    distinct = agg == "count_distinct"
    value = [F.col(value_col).alias("__value")] if distinct else []
    a = F.sum(F.col(value_col)) if agg == "sum" else F.count(F.lit(1))
    enough = F.col(out) >= F.lit(threshold)
    parts = df.groupBy(*keys, w.alias("window"), *value).agg(a.alias("__n"))  # of a window or of a pane
    if not _slides(window, slide):
        if distinct:
            parts = parts.groupBy(*keys, "window").agg(F.count("__value").alias("__n"))
        res = parts.withColumnRenamed("__n", out).filter(enough)
        return _finish(res.select(*keys, "window", out), source, ts_col, watermark)
    if df.isStreaming:
        whole = F.window(F.col("window"), window, slide).alias("window")
        if distinct:
            parts = parts.groupBy(*keys, whole, "__value").agg(F.sum("__n").alias("__n"))
            res = parts.groupBy(*keys, "window").agg(F.count("__value").alias(out))
        else:
            res = parts.groupBy(*keys, whole).agg(F.sum("__n").alias(out))
        return _finish(res.filter(enough), source, ts_col, watermark)
    pieces = panes.placed(parts, window, slide)
    if distinct:
        pieces = panes.first_seen(pieces, [*keys, "__value"]).select("*", F.col("__value").isNotNull().cast("long").alias(out), F.lit(1).alias("__held"))
        found = panes.runs(pieces, keys, [out, "__held"])
        # a value that is null counts for nothing, but its windows exist
        found = found.where("__held > 0")
    elif panes.is_exact(parts, F.col("__n")):
        pieces = pieces.where(F.col("__n").isNotNull()).withColumns({out: F.col("__n"), "__held": F.lit(1)})
        found = panes.runs(pieces, keys, [out, "__held"]).where("__held > 0")
    else:
        found = panes.runs_of_sums(pieces.withColumn(out, F.col("__n")), keys, out, window)
    found = panes.windows_of(found.where(enough), window, slide, parts.schema["window"].dataType["start"].dataType)
    return found.select(*keys, F.col(out).cast(parts.schema["__n"].dataType).alias(out), "window_start", "window_end")


def detect_syn_flood(
    df: DataFrame,
    ts_col: str,
    threshold: int,
    window: str = "1 hour",
    dst_col: str = "dstip",
    src_col: str = "srcip",
    flag_col: str = "tcpflag",
    packets_col: str = "packets",
    slide: str | None = None,
    watermark: str | None = "1 hour",
) -> DataFrame:
    """SYN packets per destination and window at or above ``threshold``.

    Output: ``dst_col``, ``window_start``, ``window_end``, ``syn_packets``,
    ``n_sources`` (distinct sources). Packets are whole numbers.
    """
    source = df
    syn = df.filter(F.col(flag_col) == F.lit("SYN")).withColumn("__packets", F.col(packets_col).cast("long"))
    syn, w = _windowed(syn, ts_col, window, slide, watermark)
    totals = F.sum("__packets").alias("syn_packets"), F.count("__source").alias("n_sources")
    enough = F.col("syn_packets") >= F.lit(threshold)
    parts = syn.groupBy(F.col(dst_col), w.alias("window"), F.col(src_col).alias("__source")).agg(F.sum("__packets").alias("__packets"))
    if not _slides(window, slide):
        return _finish(parts.groupBy(dst_col, "window").agg(*totals).filter(enough), source, ts_col, watermark)
    if syn.isStreaming:
        whole = F.window(F.col("window"), window, slide).alias("window")
        parts = parts.groupBy(dst_col, whole, "__source").agg(F.sum("__packets").alias("__packets"))
        return _finish(parts.groupBy(dst_col, "window").agg(*totals).filter(enough), source, ts_col, watermark)
    pieces, none = panes.placed(parts, window, slide), F.lit(0).cast("long")
    known = pieces.where("__packets IS NOT NULL").select("*", F.col("__packets").alias("syn_packets"), none.alias("n_sources"))
    seen = panes.first_seen(pieces.where("__source IS NOT NULL"), [dst_col, "__source"])
    seen = seen.select("*", none.alias("syn_packets"), F.lit(1).cast("long").alias("n_sources"))
    held = [c.withColumn("__held", F.lit(h)) for c, h in ((known, 1), (seen, 0))]
    found = panes.runs(held[0].unionByName(held[1]), [dst_col], ["syn_packets", "n_sources", "__held"]).where("__held > 0")
    found = panes.windows_of(found.where(enough), window, slide, parts.schema["window"].dataType["start"].dataType)
    return found.select(dst_col, "syn_packets", "n_sources", "window_start", "window_end")


def entity_features(
    df: DataFrame,
    key: str | Sequence[str],
    ts_col: str,
    window: str = "1 day",
    type_col: str = "event_type",
    types: Sequence[str] = (),
    value_col: str | None = "value",
    watermark: str | None = "1 hour",
) -> DataFrame:
    """Behaviour features per entity and window.

    ``n_events``, one ``n_<type>`` count per listed type (summed over the
    groups of types, no pivot job), ``sum_value``, ``n_types``, and the
    hour-of-day spread: ``n_hours`` distinct hours (exact, via a bit mask),
    ``first_hour``, ``last_hour``.
    """
    keys = _keys(key)
    source = df
    hour = F.hour(F.col(ts_col))
    df, w = _windowed(df, ts_col, window, None, watermark)
    # first per type: the distinct types are then the groups, and their partial sums are small
    parts = [F.count(F.lit(1)).alias("__n"), *([F.sum(value_col).alias("__sum")] if value_col else [])]
    # Distinct hours as a 24-bit mask: exact and mergeable.
    parts += [F.bit_or(F.pow(F.lit(2), hour).cast("int")).alias("__hours"), F.min(hour).alias("__first"), F.max(hour).alias("__last")]
    by_type = df.groupBy(*keys, w.alias("window"), F.col(type_col).alias("__type")).agg(*parts)
    aggs = [F.sum("__n").alias("n_events")]
    aggs += [F.coalesce(F.sum(F.when(F.col("__type") == F.lit(t), F.col("__n"))), F.lit(0).cast("long")).alias(f"n_{t}") for t in types]
    if value_col:
        aggs.append(F.sum("__sum").alias("sum_value"))
    aggs += [F.count("__type").alias("n_types"), F.bit_count(F.bit_or("__hours")).cast("bigint").alias("n_hours")]
    aggs += [F.min("__first").alias("first_hour"), F.max("__last").alias("last_hour")]
    return _finish(by_type.groupBy(*keys, "window").agg(*aggs), source, ts_col, watermark)


def brute_force_login(
    events: DataFrame,
    ts_col: str = "event_time",
    key: str | Sequence[str] = ("tenant_id", "user"),
    threshold: int = 3,
    window: str = "1 day",
    failure: str = "log_type = 'error'",
    watermark: str | None = "1 hour",
) -> DataFrame:
    """The ``BruteForce_Login`` preset: failures per entity and window at or above ``threshold`` (F2).

    ``failure`` is the SQL predicate that marks a failed attempt.
    """
    return detect_threshold(events.filter(F.expr(failure)), key, ts_col, window, threshold, watermark=watermark)
