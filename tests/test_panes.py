"""Sliding windows by panes against a plain model over every event and window."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from signals.operators import panes
from signals.operators.detect import detect_syn_flood, detect_threshold

EPOCH = dt.datetime(1970, 1, 1)


def events(seed, n=400):
    r = random.Random(seed)
    out = []
    for i in range(n):
        t = EPOCH + dt.timedelta(microseconds=r.choice([0, 1, 10**6, 59_999_999]) + r.randint(-3000, 3000) * 60 * 10**6)
        out.append((r.choice(["a", "b", None]), r.choice([t, t, t, None]), r.choice([None, 0.1, 0.25, 3.7, -2.0]), r.choice([None, 1, 2, 3, 4]), r.choice(["x", "y", "z", None])))
    return out


def model(rows, size, slide, value, combine):
    """{(key, window start): aggregate} by listing every event's windows."""
    held = {}
    for row in rows:
        if row[1] is None:
            continue
        us = (row[1] - EPOCH) // dt.timedelta(microseconds=1)
        s = us - us % slide
        while s > us - size:
            held.setdefault((row[0], EPOCH + dt.timedelta(microseconds=s)), []).append(row[value])
            s -= slide
    got = {k: combine(v) for k, v in held.items()}
    return {k: v for k, v in got.items() if v is not None}


def known_sum(v):
    v = [x for x in v if x is not None]
    return sum(v) if v else None


SCHEMA = "k string, t timestamp_ntz, x double, n long, s string"
M = 60 * 10**6


@pytest.mark.parametrize("size, slide", [("1 hour", "5 minutes"), ("50 minutes", "20 minutes"), ("1 hour", "1 hour"), ("7 minutes", "3 minutes"), ("1 day", "5 minutes")])
def test_equals_every_window(spark, size, slide):
    rows = events(hash(size) % 100)
    df = spark.createDataFrame(rows, SCHEMA)
    us = panes.micros_of(size), panes.micros_of(slide)
    cases = [("count", None, 0, len, 2), ("sum", "n", 3, known_sum, 3), ("sum", "x", 2, known_sum, 1.5), ("count_distinct", "s", 4, lambda v: len({x for x in v if x is not None}), 1), ("count_distinct", "s", 4, lambda v: len({x for x in v if x is not None}), 0)]
    for agg, col, at, combine, least in cases:
        got = {(r["k"], r["window_start"]): r["out"] for r in detect_threshold(df, "k", "t", size, least, agg=agg, value_col=col, slide=slide, out="out").collect()}
        want = {k: v for k, v in model(rows, *us, at, combine).items() if v >= least}
        assert set(got) == set(want) and want, (agg, col)
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_timestamps_in_another_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.range(200).select(F.timestamp_seconds(F.col("id") * 977 + 1711800000).alias("t"), F.lit(1).alias("k"))
        got = {(r["s"], r["e"], r["n"]) for r in detect_threshold(df, "k", "t", "1 day", 1, slide="6 hours").select(F.unix_micros("window_start").alias("s"), F.unix_micros("window_end").alias("e"), "n").collect()}
        want = df.groupBy("k", F.window("t", "1 day", "6 hours")).count()
        assert got == {(r["s"], r["e"], r["count"]) for r in want.select(F.unix_micros("window.start").alias("s"), F.unix_micros("window.end").alias("e"), "count").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_syn_flood_slides(spark):
    rows = [(r[0], r[1], r[4], "SYN" if i % 3 else "ACK", r[3]) for i, r in enumerate(events(5))]
    df = spark.createDataFrame(rows, "dstip string, t timestamp_ntz, srcip string, tcpflag string, packets long")
    got = {(r["dstip"], r["window_start"]): (r["syn_packets"], r["n_sources"]) for r in detect_syn_flood(df, "t", 2, "1 hour", slide="10 minutes").collect()}
    syn = [r for r in rows if r[3] == "SYN"]
    packets = model(syn, 60 * M, 10 * M, 4, known_sum)
    sources = model(syn, 60 * M, 10 * M, 2, lambda v: len({x for x in v if x is not None}))
    assert got == {k: (v, sources[k]) for k, v in packets.items() if v >= 2}


def test_intervals():
    assert panes.micros_of("1 day") == 86400 * 10**6 and panes.micros_of("1 hour 30 minutes") == 90 * M
    assert panes.pane_of("1 day", "7 minutes") == f"{M} microseconds"
    for bad in ("1 month", "soon", "", "5"):
        with pytest.raises(ValueError):
            panes.micros_of(bad)


def test_longer_slide_than_window(spark):
    df = spark.createDataFrame(events(1, 3), SCHEMA)
    with pytest.raises(ValueError):
        detect_threshold(df, "k", "t", "5 minutes", 1, slide="1 hour")


def test_no_expand_and_one_scan(spark):
    plan = detect_threshold(spark.createDataFrame(events(1, 9), SCHEMA), "k", "t", "1 day", 1, slide="5 minutes")._jdf.queryExecution().executedPlan().toString()
    assert not any("Expand" in line and line.count("window") > 3 for line in plan.splitlines())
