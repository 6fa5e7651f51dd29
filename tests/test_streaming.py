"""Streaming forms: tail source, keyed ring, stream-equals-batch for F2/E5/F10, status listener."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from signals.operators.detect import detect_threshold
from signals.operators.parse import normalize, parse_header
from signals.operators.response import assign_responses, policy_table
from signals.operators.tail import latest_per_source
from signals.operators.tenancy import eps_violations, limits_table, source_status
from signals.plans.fixtures import logs_from_events
from signals.session import scratch_path
from signals.sources.tail_source import read_log_tail, stream_log_tail
from signals.streaming.listener import SourceStatusListener, late_rows
from signals.streaming.ring import stream_ring, stream_rings
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def event_stream(spark):
    """sf0.001 events landed as 3 files in event-id order; a stream reads one file per trigger."""
    src = spark.read.parquet(f"{SF0001}/events.parquet")
    path = scratch_path(spark, "events-landing")
    src.repartitionByRange(3, "event_id").write.parquet(path)
    return src.schema, path


def _stream(spark, event_stream):
    schema, path = event_stream
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def _run(df, name, mode):
    spark = df.sparkSession
    q = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", scratch_path(spark, f"ckpt-{name}")).start()
    )
    q.processAllAvailable()
    q.stop()
    return spark.sql(f"SELECT * FROM {name}")


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _failures(events):
    p = normalize(parse_header(logs_from_events(events)), {"type": "kv"}, input_col="body")
    return p.filter(F.col("log_type") == "error").select(
        "event_id", "tenant_id", F.col("parsed").getItem("user").alias("user"), F.col("event_time").cast("timestamp_ntz").alias("event_time")
    )


def test_threshold_stream_equals_batch(spark, event_stream):
    batch = detect_threshold(_failures(spark.read.parquet(f"{SF0001}/events.parquet")), ["tenant_id", "user"], "event_time", "1 day", 1)
    stream = detect_threshold(_failures(_stream(spark, event_stream)), ["tenant_id", "user"], "event_time", "1 day", 1, watermark="30 days")
    got = _run(stream, "f2_stream", "complete")
    cols = ["tenant_id", "user", "window_start", "n"]
    assert _rows(got, cols) == _rows(batch, cols) and got.count() > 0


def test_eps_stream_equals_batch(spark, event_stream):
    lim = limits_table(spark, {"acme": (0.0001, 1), "bravo": (0.0001, 1)})
    batch = eps_violations(logs_from_events(spark.read.parquet(f"{SF0001}/events.parquet")), lim, "ts", per="1 day")
    stream = eps_violations(logs_from_events(_stream(spark, event_stream)), lim, "ts", per="1 day", watermark="30 days")
    got = _run(stream, "e5_stream", "complete")
    cols = ["tenant_id", "window_start", "n_events"]
    assert _rows(got, cols) == _rows(batch, cols) and got.count() > 0


def _detections(events):
    f = _failures(events).withColumnRenamed("user", "entity")
    return f.withColumn("rule", F.lit("BruteForce_Login"))


def test_response_stream(spark, event_stream):
    pol = policy_table(spark, {"BruteForce_Login": ["Isolate_Host", "Slack_Alert_Bot"]})
    bq, _ = assign_responses(_detections(spark.read.parquet(f"{SF0001}/events.parquet")), pol)
    sq, _ = assign_responses(_detections(_stream(spark, event_stream)), pol, watermark="30 days")
    got = _run(sq, "f10_stream", "complete")
    cols = ["tenant_id", "entity", "action", "window_start", "n_detections"]
    assert _rows(got, cols) == _rows(bq, cols)


def test_ring_stream_matches_batch_tail(spark, event_stream):
    logs = logs_from_events(_stream(spark, event_stream)).select("tenant_id", "source_id", "event_id", "raw_data")
    ring = stream_ring(logs, ["event_id"], capacity=5)
    latest: dict = {}

    def keep(batch_df, batch_id):
        for r in batch_df.collect():
            latest.setdefault((r["tenant_id"], r["source_id"]), {})[batch_id] = latest.get((r["tenant_id"], r["source_id"]), {}).get(batch_id, []) + [r["event_id"]]

    q = ring.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", scratch_path(spark, "ckpt-ring")).start()
    q.processAllAvailable()
    q.stop()
    final = {k: sorted(v[max(v)]) for k, v in latest.items()}
    batch = latest_per_source(logs_from_events(spark.read.parquet(f"{SF0001}/events.parquet")), "event_id", 5)
    want: dict = {}
    for r in batch.collect():
        want.setdefault((r["tenant_id"], r["source_id"]), []).append(r["event_id"])
    assert final == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("key", [(), ("tenant_id", "source_id")])
def test_rings_by_changes_equal_batch(spark, key):
    """Both rings under a source with nine tenths of the rows: the changes add up to the newest rows of the batch."""
    rows = spark.range(3000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 10 == 0, F.lit("quiet")).otherwise(F.lit("noisy")).alias("source_id"),
        F.lit("acme").alias("tenant_id"),
        F.when(F.col("id") % 7 != 0, F.col("id")).alias("n"),  # nulls in the state
        F.concat(F.lit("line "), F.col("id")).alias("raw_data"),
    )
    path = scratch_path(spark, "rings-landing")
    for low, high in ((1000, 2000), (2000, 3000), (0, 1000)):  # the oldest come last
        rows.where(f"event_id >= {low} and event_id < {high}").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    held, sizes = {}, []

    def keep(batch, _):
        got = batch.collect()
        sizes.append(len(got))
        for r in sorted(got, key=lambda r: r["ring_change"], reverse=True):
            if r["ring_change"] == "leaves":
                del held[r["event_id"]]
            else:
                held[r["event_id"]] = tuple(r[c] for c in rows.columns)

    q = stream_rings(stream, ["event_id"], 40, key, salts=4).writeStream.outputMode("append").foreachBatch(keep)
    q = q.option("checkpointLocation", scratch_path(spark, "ckpt-rings")).start()
    q.processAllAvailable()
    q.stop()
    want = rows.orderBy(F.desc("event_id")).limit(40) if not key else latest_per_source(rows, "event_id", 40)
    assert sorted(held.values()) == sorted(tuple(r[c] for c in rows.columns) for r in want.collect())
    rings = 2 if key else 1
    assert [n for n in sizes if n] == [40 * rings, 80 * rings]  # the last file changes nothing


def test_tail_source_stream_and_batch(spark, tmp_path):
    d = tmp_path / "tail"
    d.mkdir()
    f = d / "app.log"
    f.write_bytes(b"old1\nold2\n")
    with pytest.raises(ValueError):
        stream_log_tail(spark, str(d), read_from="middle")
    q = stream_log_tail(spark, str(d), read_from="end").writeStream.format("memory").queryName("tail_t").start()
    try:
        q.processAllAvailable()
        assert spark.sql("SELECT * FROM tail_t").count() == 0
        with open(f, "ab") as h:
            h.write(b"new1\r\nnew2\rnew3\npart")
        q.processAllAvailable()
        with open(f, "ab") as h:
            h.write(b"ial\n")
        (d / "b.log").write_bytes(b"b1\n")
        q.processAllAvailable()
        got = sorted((r["raw_data"], r["offset"], os.path.basename(r["file_path"])) for r in spark.sql("SELECT * FROM tail_t").collect())
    finally:
        q.stop()
    assert got == sorted([("new1", 16, "app.log"), ("new2", 21, "app.log"), ("new3", 26, "app.log"), ("partial", 34, "app.log"), ("b1", 3, "b.log")])
    batch = sorted((r["raw_data"], r["offset"]) for r in read_log_tail(spark, str(f), partition_bytes=6).collect())
    assert batch == sorted([("old1", 5), ("old2", 10), ("new1", 16), ("new2", 21), ("new3", 26), ("partial", 34)])


def test_listener_feeds_source_status(spark, event_stream):
    lst = SourceStatusListener()
    spark.streams.addListener(lst)
    try:
        df = logs_from_events(_stream(spark, event_stream)).select("raw_data")
        q = (
            df.writeStream.format("noop").queryName("acme::file_event")
            .option("checkpointLocation", scratch_path(spark, "ckpt-listener")).start()
        )
        q.processAllAvailable()
        q.stop()
        import time

        time.sleep(1.0)
        st = source_status(lst.reports(spark)).collect()
    finally:
        spark.streams.removeListener(lst)
    assert len(st) == 1 and st[0]["tenant_id"] == "acme" and st[0]["source_id"] == "file_event"
    assert st[0]["running"] is False and st[0]["healthy"] is True and late_rows(q) == 0
    assert '"sources"' in st[0]["config"] and "FileStreamSource" in st[0]["config"]  # kept after the stop


def _drain(df, checkpoint, got):
    """Run a query until nothing is left; its rows go to ``got``. Returns the rows of each batch."""
    take = lambda batch, _: got.extend((r["raw_data"], r["offset"]) for r in batch.collect())
    q = df.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).start()
    try:
        q.processAllAvailable()
        return [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0]
    finally:
        q.stop()


def test_tail_source_caps_bytes_from_the_first_batch(spark, tmp_path):
    """A backlog of 50 caps takes 50 batches; a restarted query goes on where it was, capped."""
    (tmp_path / "logs").mkdir()
    f, ckpt = tmp_path / "logs" / "a.log", str(tmp_path / "ckpt")
    f.write_bytes(b"l1\nl2\nl3\nl4\n" * 50)  # 12 bytes each
    tail = lambda: stream_log_tail(spark, str(tmp_path / "logs"), read_from="start", max_bytes_per_trigger=12, checkpoint=ckpt)
    got = []
    sizes = _drain(tail(), ckpt, got)
    assert len(sizes) == 50 and set(sizes) == {4} and len(got) == 200
    with open(f, "ab") as h:
        h.write(b"m1\nm2\nm3\nm4\nm5\nm6\n" + b"x" * 40 + b"\n")
    got = []
    sizes = _drain(tail(), ckpt, got)
    assert [g[0] for g in sorted(got, key=lambda g: g[1])] == ["m1", "m2", "m3", "m4", "m5", "m6", "x" * 40]
    assert max(sizes) <= 4 and len(sizes) == 3
    with pytest.raises(ValueError):
        stream_log_tail(spark, str(tmp_path / "logs"), max_bytes_per_trigger=12)


def test_tail_source_keeps_positions_of_files_a_listing_misses(tmp_path):
    from signals.sources.tail_source import _TailStreamReader

    f = tmp_path / "a.log"
    f.write_bytes(b"one\n")
    r = _TailStreamReader({"path": str(tmp_path), "read_from": "start"})
    first = r.latestOffset()
    r.partitions(r.initialOffset(), first)
    f.rename(tmp_path / ".hidden")
    second = r.latestOffset()
    (tmp_path / ".hidden").rename(f)
    third = r.latestOffset()
    assert first == second == third and r.partitions(second, third) == []


def test_tail_ranges_cover_every_line_once(tmp_path):
    from signals.sources.tail_source import _ranges, _read_range

    f = tmp_path / "a.log"
    f.write_bytes(b"".join(b"line %d%s\n" % (i, b"x" * (i % 37)) for i in range(500)))
    size = f.stat().st_size
    for chunk in (1, 7, 64, 1000, size, 2 * size):
        got = [x for p in _ranges(str(f), 0, size, chunk) for b in _read_range(p) for x in b.column(1).to_pylist()]
        assert got == sorted(set(got)) and len(got) == 500


@pytest.fixture(scope="module")
def ended_stream(spark):
    """sf0.001 events as 3 files, then one event two years later that closes all windows before it."""
    src = spark.read.parquet(f"{SF0001}/events.parquet")
    path = scratch_path(spark, "ended-landing")
    src.repartitionByRange(3, "event_id").write.parquet(path)
    time.sleep(1.1)  # the file source orders files by modification time
    src.limit(1).withColumn("ts", F.expr("timestamp_ntz'2026-06-01 00:00:00'")).coalesce(1).write.mode("append").parquet(path)
    return src.schema, path


def _closed(df, name, cols):
    return sorted(tuple(r[c] for c in cols) for r in _run(df, name, "append").where("window_end < '2026-01-01'").collect())


def _deny(events):
    e = F.col("event_type") == "error"
    return events.select(
        F.col("ts").alias("event_time"), F.concat(F.lit("d"), F.col("user_id") % 3).alias("dstip"), F.col("user_id").alias("srcip"),
        F.when(e, F.lit("SYN")).otherwise(F.lit("ACK")).alias("tcpflag"), (1 + F.col("event_id") % 50).alias("packets"),
    )


@pytest.mark.parametrize("window, slide", [("3 days", None), ("3 days", "1 day")])
def test_syn_flood_stream_equals_batch(spark, ended_stream, window, slide):
    from signals.operators.detect import detect_syn_flood

    cols = ["dstip", "window_start", "window_end", "syn_packets", "n_sources"]
    batch = detect_syn_flood(_deny(spark.read.parquet(f"{SF0001}/events.parquet")), "event_time", 1, window=window, slide=slide)
    stream = detect_syn_flood(_deny(_stream(spark, ended_stream)), "event_time", 1, window=window, slide=slide, watermark="60 days")
    assert "approx" not in stream._jdf.queryExecution().analyzed().toString()
    assert _closed(stream, f"f3_stream_{slide is None}", cols) == _rows(batch, cols) and batch.count() > 20


def test_features_stream_equals_batch(spark, ended_stream):
    from signals.operators.detect import entity_features

    args = ("user_id", "ts", "3 days"), {"types": ("click", "error"), "value_col": "event_id"}
    cols = ["user_id", "window_start", "n_events", "n_click", "n_error", "sum_value", "n_types", "n_hours", "first_hour", "last_hour"]
    batch = entity_features(spark.read.parquet(f"{SF0001}/events.parquet"), *args[0], **args[1])
    stream = entity_features(_stream(spark, ended_stream), *args[0], watermark="60 days", **args[1])
    assert _closed(stream, "f4_stream", cols) == _rows(batch, cols) and batch.count() > 20


@pytest.mark.parametrize("agg", ["count", "sum", "count_distinct"])
def test_sliding_threshold_stream_equals_batch(spark, ended_stream, agg):
    args = (["user_id"], "ts", "2 days", 3), {"agg": agg, "value_col": "event_id" if agg == "sum" else "event_type", "slide": "12 hours"}
    cols = ["user_id", "window_start", "window_end", "n"]
    batch = detect_threshold(spark.read.parquet(f"{SF0001}/events.parquet"), *args[0], **args[1])
    stream = detect_threshold(_stream(spark, ended_stream), *args[0], watermark="60 days", **args[1])
    assert _closed(stream, f"f2_slide_{agg}", cols) == _rows(batch, cols) and batch.count() > 20


def test_late_rows_are_dropped_and_counted(spark):
    """Late-event filtering uses the previous batch's watermark (Spark 3.4+), so the late file comes third."""
    src = spark.read.parquet(f"{SF0001}/events.parquet")
    path = scratch_path(spark, "late-landing")
    for cond in ("ts >= '2024-01-15' AND ts < '2024-01-23'", "ts >= '2024-01-23'", "ts < '2024-01-05'"):
        src.filter(cond).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # the file source orders files by modification time
    stream = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).parquet(path)
    lim = limits_table(spark, {"acme": (0.0, 1), "bravo": (0.0, 1)})
    v = eps_violations(logs_from_events(stream), lim, "ts", per="1 hour", watermark="1 hour")
    q = (
        v.writeStream.format("memory").queryName("late_t").outputMode("update")
        .option("checkpointLocation", scratch_path(spark, "ckpt-late")).start()
    )
    try:
        q.processAllAvailable()
        progress = [p for p in q.recentProgress if p["numInputRows"] > 0]
        dropped = sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in progress for op in p.get("stateOperators", []))
        early = spark.sql("SELECT * FROM late_t WHERE window_start < '2024-01-05'").count()
        helper = late_rows(q, recent=True)
    finally:
        q.stop()
    assert len(progress) == 3 and dropped > 0 and early == 0 and helper == dropped


def test_first_responses_stream(spark, event_stream):
    from signals.operators.response import first_responses

    pol = policy_table(spark, {"BruteForce_Login": ["Isolate_Host", "Slack_Alert_Bot"]})
    bq, _ = assign_responses(_detections(spark.read.parquet(f"{SF0001}/events.parquet")), pol)
    sq = first_responses(_detections(_stream(spark, event_stream)), pol, watermark="30 days")
    got = _run(sq, "f10_first", "append")
    cols = ["tenant_id", "entity", "action", "window_start"]
    assert _rows(got, cols) == _rows(bq, cols)


def test_ingest_stream_to_zone_and_quarantine(spark, tmp_path):
    from signals.sources.files import write_lines
    from signals.sources.zones import read_zone
    from signals.streaming.ingest import ingest_stream

    landing = scratch_path(spark, "landing")
    rl = logs_from_events(spark.read.parquet(f"{SF0001}/events.parquet"))
    write_lines(rl.coalesce(2), landing)
    root = scratch_path(spark, "zones-stream")
    ck = scratch_path(spark, "ckpt-ingest")
    qs = ingest_stream(spark, landing, "acme", "file_event", {"type": "kv"}, root, ck, trigger_available_now=True)
    for q in qs:
        q.awaitTermination(120)
    z = read_zone(spark, root, "data/processed", tenant_id="acme")
    assert z.count() == rl.count() and z.filter("parse_status <> 'parsed'").count() == 0
    assert z.select("dt").distinct().count() == rl.select(F.to_date("ts")).distinct().count()
    # a broken rule sends every non-empty line to quarantine
    qdir = scratch_path(spark, "quarantine")
    qs = ingest_stream(spark, landing, "acme", "file_event", {"type": "nope"}, root, scratch_path(spark, "ckpt-ingest2"),
                       quarantine_dir=qdir, trigger_available_now=True)
    for q in qs:
        q.awaitTermination(120)
    assert spark.read.parquet(qdir).count() == rl.count()


def test_rules_grep_route_on_streams(spark, event_stream):
    from signals.operators.detect import Rule, detect_rules
    from signals.operators.grep import grep, route

    rules = [Rule("errors", "event_type = 'error'", "Major"), Rule("big", "value > 300", "Critical")]

    def build(events):
        rl = logs_from_events(events)
        d = detect_rules(rl, rules).select("event_id", "rule")
        g = grep(rl, [r"\[(error|view)\]", "user=user1"]).select("event_id", F.lit("grep").alias("rule"))
        r = route(rl, {"err": r"\[error\]", "buy": "purchase"}).select("event_id", "route")
        return d.unionByName(g), r

    bd, br = build(spark.read.parquet(f"{SF0001}/events.parquet"))
    sd, sr = build(_stream(spark, event_stream))
    assert _rows(_run(sd, "rules_stream", "append"), ["event_id", "rule"]) == _rows(bd, ["event_id", "rule"])
    assert _rows(_run(sr, "route_stream", "append"), ["event_id", "route"]) == _rows(br, ["event_id", "route"])


def test_stream_routes_sink_partitions_by_route(spark, event_stream):
    from signals.operators.grep import route, stream_routes

    routes = {"err": r"\[error\]", "buy": "purchase"}
    routed = route(logs_from_events(_stream(spark, event_stream)), routes).select("event_id", "raw_data", "route")
    out = scratch_path(spark, "routes-stream")
    q = stream_routes(routed, out, scratch_path(spark, "ckpt-routes"))
    q.processAllAvailable()
    q.stop()
    got = {r["route"]: r["n"] for r in spark.read.parquet(out).groupBy("route").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {r["route"]: r["n"] for r in route(logs_from_events(spark.read.parquet(f"{SF0001}/events.parquet")), routes)
            .groupBy("route").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want and set(got) == {"err", "buy", "default"}
    assert spark.read.parquet(out).filter("route = 'err'").count() == want["err"]  # pruned to one folder
