"""Unit tests for tails, sequences, grep, schema catalog, tenancy, risk, response and sources."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from signals.operators.envelope import stamp
from signals.operators.grep import grep, route, write_routes
from signals.operators.risk import risk_scores, top_risks
from signals.operators.response import assign_responses, policy_table
from signals.operators.schema import revise_schema, schema_diff, current_schema
from signals.operators.sequence import arrival_sequence
from signals.operators.tail import check_limit, latest_global, latest_per_source, latest_view, retain_latest
from signals.operators.tenancy import all_healthy, entitled, grants_table, source_status, tenants_table, valid_tenant
from signals.session import scratch_path
from signals.sources.artifacts import read_schema_artifacts, schema_fields
from signals.sources.files import read_logs
from signals.sources.ledger import offset_ledger
from signals.sources.metrics import read_training_metrics
from signals.sources.zones import read_zone, write_zone


def test_stamp_overwrites(spark):
    df = spark.createDataFrame([("x", "old", "s", 1)], "raw_data string, tenant_id string, source_id string, extra int")
    r = stamp(df, "acme", "file_event").first()
    assert (r["tenant_id"], r["source_id"], r["extra"]) == ("acme", "file_event", 1)


@pytest.mark.parametrize("bad", [0, -1, 5001, 2.5, True])
def test_limit_bounds(bad):
    with pytest.raises(ValueError):
        check_limit(bad)


def _events(spark, n=300):
    rows = [(i, "acme" if i % 3 else "bravo", "s1" if i % 5 else "s2", f"line {i}") for i in range(n)]
    return spark.createDataFrame(rows, "event_id long, tenant_id string, source_id string, raw_data string")


def test_tails(spark):
    df = _events(spark)
    g = [r["event_id"] for r in latest_global(df, "event_id", 10).collect()]
    assert g == list(range(290, 300))  # oldest first
    per = latest_per_source(df, "event_id", 3).collect()
    assert len(per) == 4 * 3
    # the viewer filters after the limit: a quiet source can show nothing
    assert latest_view(df, "event_id", "bravo", "s2", 1).count() == 0
    kept = retain_latest(df, "event_id", "event_id", per_source=5, total=7).collect()
    ids = {r["event_id"] for r in kept}
    assert set(range(293, 300)) <= ids and len(ids) == len(kept)


def test_arrival_sequence_hot_key_and_nulls(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 7 == 0 else ("hot" if i % 10 < 8 else f"k{i % 3}"), base + dt.timedelta(minutes=i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp")
    got = arrival_sequence(df, ["k"], ["ts", "id"], bucket="hour")
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")))
    j = got.join(ref.select("id", "rn"), "id")
    assert j.count() == 2000 and j.filter("seq != rn").count() == 0


def test_large_buckets_are_cut_evenly(spark):
    """A third of the rows share one time, a few share the whole order: parts stay near max_rows, numbers are exact."""
    from signals.operators.sequence import ordered_groups

    base = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 11 == 0 else "k", base + dt.timedelta(seconds=0 if i % 3 == 0 else i)) for i in range(9000)]
    rows += [(None, "k", None)] * 5 + [(7, "k", base)] * 4
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp").repartition(4)
    groups, counts = ordered_groups(df, ["k"], ["ts", "id"], "hour", 200)
    sizes = sorted(r["__cnt"] for r in counts.collect())
    assert sum(sizes) == len(rows) == groups.count() and sizes[-1] < 400 and sizes[-1] < 2.5 * sizes[len(sizes) // 2]
    got = arrival_sequence(df, ["k"], ["ts", "id"], bucket="hour", max_rows=200)
    number = {}
    for r in got.collect():
        number.setdefault((r["k"], r["ts"], r["id"]), []).append(r["seq"])
    first = lambda x: (x is not None, x or 0)
    want, at = {}, {}
    for i, k, t in sorted(rows, key=lambda r: (first(r[1]), (r[2] is not None, r[2] or base), first(r[0]))):
        at[k] = at.get(k, 0) + 1
        want.setdefault((k, t, i), []).append(at[k])
    assert {k: sorted(v) for k, v in number.items()} == want


def test_trie_pattern_is_the_longest_literal():
    import random
    import re

    from signals.operators.grep import trie_pattern

    r = random.Random(4)
    for _ in range(300):
        words = ["".join(r.choice("ab.(é") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 12))]
        text = "".join(r.choice("ab.(éc") for _ in range(30))
        p = re.compile(f"(?=({trie_pattern(words)}))")
        got = [(m.start(), m[1]) for m in p.finditer(text)]
        want = [(i, max((w for w in words if text.startswith(w, i)), key=len)) for i in range(len(text)) if any(text.startswith(w, i) for w in words)]
        assert got == want


def test_many_literals_and_routes(spark):
    import random

    r = random.Random(6)
    word = lambda: "".join(r.choice("abc.$") for _ in range(r.randint(2, 4)))
    words = sorted({word() for _ in range(160)})
    texts = ["".join(r.choice("abc.$ é") for _ in range(r.randint(0, 25))) for _ in range(150)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw_data string")
    held = lambda t, ws: t is not None and any(w in t for w in ws)
    for mode, want in (("any", True), ("none", False)):
        got = {x["i"] for x in grep(df, words, mode=mode, fixed=True).collect()}
        assert got == {i for i, t in enumerate(texts) if held(t, words) == want}
    plain = [w for w in words if not set(w) & set(".$")]
    routes = {f"r{k}": plain[k::7] for k in range(7)} | {"re": r"a.c", "one": "abc"}
    assert len(plain) > 16
    got = sorted((x["i"], x["route"]) for x in route(df, routes).collect())
    import re

    want = []
    for i, t in enumerate(texts):
        mine = [n for n, p in routes.items() if (t is not None and re.search(p, t) if n == "re" else held(t, [p] if isinstance(p, str) else p))]
        want += [(i, n) for n in (mine or ["default"])]
    assert got == sorted(want)
    plan = grep(df, words, fixed=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("RLIKE(") == 1 and "Contains(" not in plan


def test_grep_modes(spark):
    df = spark.createDataFrame([("ERROR disk full",), ("warn cpu",), ("ERROR cpu hot",), (None,)], "raw_data string")
    assert grep(df, ["ERROR", "cpu"], mode="any").count() == 3
    assert grep(df, ["ERROR", "cpu"], mode="all").count() == 1
    assert grep(df, ["ERROR", "cpu"], mode="none").count() == 1  # null text matches nothing
    assert grep(df, ["E.R+OR"], invert=True).count() == 2
    assert grep(df, ["c.u"], fixed=True).count() == 0


def test_route_and_sink(spark):
    df = spark.createDataFrame([(1, "ERROR x"), (2, "ok"), (3, "ERROR token")], "id int, raw_data string")
    r = route(df, {"errors": "ERROR", "secrets": ["token", "password"]})
    got = sorted((x["id"], x["route"]) for x in r.collect())
    assert got == [(1, "errors"), (2, "default"), (3, "errors"), (3, "secrets")]
    path = scratch_path(spark, "routes")
    write_routes(r, path)
    assert spark.read.parquet(path).filter("route = 'secrets'").count() == 1


def test_revise_and_diff(spark):
    cat = spark.createDataFrame(
        [("t", "ev", 1, 0, "a", "string", "90%"), ("t", "ev", 1, 1, "b", "integer", "99%"), ("t", "ev", 1, 2, "c", "ip_address", "95%")],
        "tenant_id string, log_type string, version int, pos int, name string, type string, confidence string",
    )
    v2 = revise_schema(cat, "t", "ev", remove=[1], add=2)
    cur = sorted((r["pos"], r["name"], r["version"]) for r in current_schema(v2).collect())
    assert cur == [(0, "a", 2), (1, "c", 2), (2, "new_field", 2), (3, "new_field", 2)]
    v3 = revise_schema(cat, "t", "ev", replace=[("a", "integer", "Manual")])
    d = {r["name"]: r["verdict"] for r in schema_diff(cat, current_schema(v3)).collect()}
    assert d == {"a": "changed", "b": "removed", "c": "removed"}


def test_xml_artifacts_defaults(spark, tmp_path):
    root = tmp_path / "arts"
    (root / "tenant_id=acme" / "artifact=schema_event_20260101_000000.xml").mkdir(parents=True)
    (root / "tenant_id=acme" / "artifact=schema_event_20260101_000000.xml" / "part-0.xml").write_text(
        '<?xml version="1.0" ?>\n<LogSchema tenant="acme" type="event">\n  <Field name="ts" type="datetime" confidence="99%"/>\n'
        '  <Field name="user"/>\n  <Field type="integer"/>\n</LogSchema>\n'
    )
    a = read_schema_artifacts(spark, str(root))
    rows = sorted((r["pos"], r["name"], r["type"], r["confidence"]) for r in a.collect())
    assert rows == [(0, "ts", "datetime", "99%"), (1, "user", "string", "100%"), (2, "", "integer", "100%")]
    assert schema_fields(a, "acme", "event") == [("ts", "datetime"), ("user", "string"), ("", "integer")]


def test_tenancy(spark):
    df = spark.createDataFrame([("acme", "grep_pipeline"), ("bravo", "grep_pipeline"), ("bravo", "detect"), ("zed", "detect")], "tenant_id string, module_id string")
    t = tenants_table(spark, {"acme": "ENTERPRISE", "bravo": "basic", "zed": "platinum"})
    got = sorted((r["tenant_id"], r["module_id"]) for r in entitled(df, t, grants_table(spark)).collect())
    assert got == [("acme", "grep_pipeline"), ("bravo", "detect")]
    v = spark.createDataFrame([("ab",), ("a",), ("a b",), ("x" * 64,), ("x" * 65,), (None,), ("a-_9",)], "s string")
    assert [r["ok"] for r in v.select(valid_tenant("s").alias("ok")).collect()] == [True, False, False, True, False, False, True]


def test_source_status_keeps_error_until_data(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [
        ("a", "s", t0, True, True, None, 5, "{}"),
        ("a", "s", t0 + dt.timedelta(seconds=1), True, False, "open failed", 0, "{}"),
        ("a", "s", t0 + dt.timedelta(seconds=2), True, True, None, 0, "{}"),  # empty poll: the reference would clear the error
        ("b", "s", t0, True, False, "boom", 0, "{}"),
        ("b", "s", t0 + dt.timedelta(seconds=3), True, True, None, 2, "{}"),
    ]
    df = spark.createDataFrame(rows, "tenant_id string, source_id string, ts timestamp, running boolean, healthy boolean, error string, n_records int, config string")
    st = {r["tenant_id"]: r for r in source_status(df).collect()}
    assert st["a"]["last_error"] == "open failed" and st["a"]["healthy"] is False
    assert st["b"]["last_error"] is None and st["b"]["healthy"] is True
    assert all_healthy(source_status(df)).first()["all_healthy"] is False
    assert all_healthy(source_status(df.filter("tenant_id = 'b'"))).first()["all_healthy"] is True
    assert all_healthy(source_status(df.limit(0))).first()["all_healthy"] is True


def test_risk_and_response(spark):
    t0 = dt.datetime(2024, 1, 1, 12)
    det = spark.createDataFrame(
        [(1, "acme", "u1", "Critical", "R1", t0), (2, "acme", "u1", "Critical", "R1", t0), (3, "acme", "u1", "3", "R2", t0),
         (4, "acme", "u2", "Minor", "R2", t0), (5, "bravo", "u3", "Info", "R3", t0)],
        "event_id long, tenant_id string, entity string, severity string, rule string, event_time timestamp",
    )
    sc = {(r["tenant_id"], r["entity"]): (r["score"], r["rank"]) for r in risk_scores(det).collect()}
    assert sc[("acme", "u1")] == (100.0, 1) and sc[("acme", "u2")] == (5.0, 2) and sc[("bravo", "u3")] == (1.0, 1)
    assert [r["entity"] for r in top_risks(risk_scores(det), "acme", 1).collect()] == ["u1"]
    q, un = assign_responses(det, policy_table(spark, {"R1": ["Block_IP", "Slack_Alert_Bot"], "R2": "Isolate_Host"}))
    assert q.count() == 4 and sorted(r["event_id"] for r in un.collect()) == [5]


def test_read_logs_offsets_across_splits(spark, tmp_path):
    d = tmp_path / "logs"
    d.mkdir()
    lines = [f"line {i} " + "x" * (i % 37) for i in range(4000)]
    (d / "a.log").write_text("".join(s + "\n" for s in lines))
    (d / "b.log").write_bytes(b"ok\n\xff\xfebad\nlast\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # many splits per file
    try:
        got = read_logs(spark, str(d)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    a = sorted((r["line_no"], r["raw_data"], r["offset"]) for r in got if r["file_path"].endswith("a.log"))
    pos, want = 0, []
    for i, s in enumerate(lines):
        pos += len(s.encode()) + 1
        want.append((i + 1, s, pos))
    assert a == want
    b = sorted((r["line_no"], r["raw_data"], r["offset"]) for r in got if r["file_path"].endswith("b.log"))
    assert b == [(1, "ok", 3), (2, "��bad", 9), (3, "last", 14)]


def _universal_lines(data: bytes):
    """Python model: lines split at \\r\\n, \\r or \\n, with the byte position after each terminator."""
    out, start, i, n = [], 0, 0, len(data)
    while i < n:
        ch = data[i : i + 1]
        if ch in (b"\r", b"\n"):
            end = i + 2 if data[i : i + 2] == b"\r\n" else i + 1
            out.append((data[start:i].decode("utf-8", "replace"), end))
            start = i = end
        else:
            i += 1
    if start < n:
        out.append((data[start:].decode("utf-8", "replace"), n))
    return out


def test_read_logs_universal_newlines(spark, tmp_path):
    d = tmp_path / "mixed"
    d.mkdir()
    files = {
        "crlf.log": b"a=1\r\nb=22\r\n\r\nc=333\r\n",
        "cr.log": b"x\ry\r\nz\n\rw",
        "nofinal.log": b"one\ntwo\nthree",
        "bad.log": b"\xff\r\nok\n",
    }
    for name, data in files.items():
        (d / name).write_bytes(data)
    got = read_logs(spark, str(d)).collect()
    for name, data in files.items():
        mine = sorted((r["line_no"], r["raw_data"], r["offset"]) for r in got if r["file_path"].endswith(name))
        want = [(i + 1, line, off) for i, (line, off) in enumerate(_universal_lines(data))]
        assert mine == want, name


def test_zone_partition_pruning(spark):
    root = scratch_path(spark, "zonetest")
    df = spark.createDataFrame([("acme", dt.datetime(2024, 1, 1), "x"), ("bravo", dt.datetime(2024, 1, 2), "y")], "tenant_id string, ts timestamp, raw_data string")
    write_zone(df, root, "data/raw", date_col="ts")
    z = read_zone(spark, root, "data/raw", tenant_id="acme")
    assert z.count() == 1
    plan = z._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "tenant_id" in plan
    with pytest.raises(ValueError):
        write_zone(df, root, "nope")


def test_offset_ledger_last_not_max(spark):
    df = spark.createDataFrame([("a", "s", 1, 100), ("a", "s", 2, 50), ("a", "s", 3, None), ("b", "s", 1, None)], "tenant_id string, source_id string, seq long, offset long")
    got = {r["ledger_key"]: r["offset"] for r in offset_ledger(df).collect()}
    assert got == {"a::s": 50}


def test_metrics_missing_and_corrupt(spark, tmp_path):
    root = tmp_path / "metrics"
    good = root / "tenant_id=acme" / "module=ml_detect"
    bad = root / "tenant_id=acme" / "module=team_parser"
    good.mkdir(parents=True)
    bad.mkdir(parents=True)
    (good / "m.json").write_text('{\n  "trained_pct": 87.5,\n  "data_points": 1200,\n  "last_trained_at": "2026-02-27T11:30:00.123456+09:00",\n  "last_error": null\n}\n')
    (bad / "m.json").write_text("{not json")
    mods = spark.createDataFrame([("acme", "ml_detect"), ("acme", "team/parser"), ("acme", "viewer")], "tenant_id string, module_id string")
    got = {r["module_id"]: r for r in read_training_metrics(spark, str(root), mods).collect()}
    assert got["ml_detect"]["trained_pct"] == 87.5 and got["ml_detect"]["data_points"] == 1200
    assert str(got["ml_detect"]["last_trained_at"]) == "2026-02-27 02:30:00.123456"  # offset applied, UTC session
    assert got["team/parser"]["last_error"].startswith("metric read error") and got["team/parser"]["data_points"] == 0
    assert got["viewer"]["trained_pct"] == 0.0 and got["viewer"]["last_error"] is None and got["viewer"]["last_trained_at"] is None


def test_train_schemas_round_trip(spark):
    from signals.operators.parse import apply_schema
    from signals.operators.schema import train_schemas
    from signals.plans.q_parse import fields_map, parsed_logs
    from signals.sources.zones import zone_root

    parsed = fields_map(parsed_logs(spark, "/root/testdata/sf0.001"))
    root, hist_path = scratch_path(spark, "train"), scratch_path(spark, "train-history")
    hist = train_schemas(parsed, root, hist_path, map_col="fields", run_time=F.to_timestamp(F.lit("2024-02-01 00:00:00")), run_id="r1")
    assert hist.count() == 10 and spark.read.parquet(hist_path).count() == 10
    arts = read_schema_artifacts(spark, zone_root(root, "artifacts/parsers"))
    fields = schema_fields(arts, "acme", "error")
    assert dict(fields) == {
        "action": "string", "bytes": "integer", "event_time": "datetime", "priority": "integer",
        "sender_ip": "ip_address", "srcip": "ip_address", "user": "string", "value": "string",
    }
    typed = apply_schema(parsed.filter("tenant_id = 'acme' AND log_type = 'error'"), fields, map_col="fields")
    assert typed.filter(F.size("cast_errors") > 0).count() == 0


def test_metrics_and_artifacts_in_tenant_folders(spark, tmp_path):
    """The per-tenant folder layout: <tenant>/metrics/<module>.json and <tenant>/artifacts/parsers/*.xml."""
    root = tmp_path / "tenants"
    (root / "acme" / "metrics").mkdir(parents=True)
    (root / "acme" / "metrics" / "ml_detect.json").write_text('{"trained_pct": 40.0, "data_points": 7, "last_trained_at": "2026-02-27T11:30:00Z", "last_error": null}')
    (root / "acme" / "metrics" / "team_parser.json").write_text("not json")
    (root / "bravo" / "metrics").mkdir(parents=True)
    mods = spark.createDataFrame([("acme", "ml_detect"), ("acme", "team/parser"), ("bravo", "detect")], "tenant_id string, module_id string")
    got = {(r["tenant_id"], r["module_id"]): r for r in read_training_metrics(spark, str(root), mods, layout="files").collect()}
    assert got[("acme", "ml_detect")]["data_points"] == 7
    assert got[("acme", "team/parser")]["last_error"].startswith("metric read error")
    assert got[("bravo", "detect")]["trained_pct"] == 0.0
    parsers = root / "acme" / "artifacts" / "parsers"
    parsers.mkdir(parents=True)
    (parsers / "schema_event_20260227_144029.xml").write_text(
        '<?xml version="1.0" ?>\n<LogSchema tenant="acme" type="event">\n  <Field name="user" type="string" confidence="95%"/>\n</LogSchema>\n'
    )
    arts = read_schema_artifacts(spark, str(root / "*" / "artifacts" / "parsers" / "*.xml")).collect()
    assert [(a["tenant"], a["log_type"], a["file_name"], a["name"]) for a in arts] == [("acme", "event", "schema_event_20260227_144029.xml", "user")]


def test_tail_source_reads_a_truncated_file_from_the_start(spark, tmp_path):
    from signals.sources.tail_source import stream_log_tail

    d = tmp_path / "rot"
    d.mkdir()
    f = d / "app.log"
    f.write_bytes(b"aaaa\nbbbb\n")
    q = stream_log_tail(spark, str(d), read_from="start").writeStream.format("memory").queryName("tail_rot").start()
    try:
        q.processAllAvailable()
        f.write_bytes(b"c\n")  # truncated and rewritten
        q.processAllAvailable()
        got = sorted((r["raw_data"], r["offset"]) for r in spark.sql("SELECT * FROM tail_rot").collect())
    finally:
        q.stop()
    assert got == [("aaaa", 5), ("bbbb", 10), ("c", 2)]


def test_read_zone_tenant_dirs(spark, tmp_path):
    root = tmp_path / "tenants"
    for t, n in (("acme", 3), ("bravo", 2)):
        spark.range(n).withColumnRenamed("id", "x").write.parquet(str(root / t / "data" / "raw"))
    z = read_zone(spark, str(root), "data/raw", layout="tenant_dirs")
    assert sorted((r["tenant_id"], r["count"]) for r in z.groupBy("tenant_id").count().collect()) == [("acme", 3), ("bravo", 2)]
    assert read_zone(spark, str(root), "data/raw", tenant_id="bravo", layout="tenant_dirs").count() == 2


def test_wide_envelope_and_offset_lookup(spark):
    from signals.operators.envelope import DATAGRAM_EVENT, FILE_EVENT, combine_envelopes
    from signals.sources.ledger import get_offset

    files = spark.createDataFrame([("a=1", 4, "/x.log")], FILE_EVENT)
    grams = spark.createDataFrame([("b=2", 0, dt.datetime(2024, 1, 1), 1, ("10.0.0.1", 514))], DATAGRAM_EVENT)
    env = combine_envelopes(stamp(files, "acme", "file_event"), stamp(grams, "acme", "syslog_event"))
    assert set(env.columns) >= {"raw_data", "offset", "file_path", "received_at", "seq", "remote_addr", "tenant_id", "source_id"}
    assert env.count() == 2 and env.filter("file_path IS NULL").count() == 1
    ledger = offset_ledger(env.withColumn("seq", F.coalesce("seq", F.lit(1))))
    assert [r["offset"] for r in get_offset(ledger, "acme", "file_event").collect()] == [4]
    assert get_offset(ledger, "acme", "nope").count() == 0


def test_apply_recommended_keeps_explicit_settings(spark):
    from signals.session import _RUNTIME_KEYS, apply_recommended

    saved = {k: spark.conf.get(k, None) for k in _RUNTIME_KEYS}
    try:
        done = apply_recommended(spark, 50 << 20, total_cores=4)
        # the test session set shuffle partitions at build time: it is kept
        assert "spark.sql.shuffle.partitions" not in done and spark.conf.get("spark.sql.shuffle.partitions") == saved["spark.sql.shuffle.partitions"]
        assert done.get("spark.sql.files.maxPartitionBytes") == str(256 << 20)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("limit", [3, 1500, 5000])
def test_latest_per_source_large_rings_equal_row_number(spark, limit):
    """Above the window group limit threshold the bucketed path must give exactly the row_number result."""
    base = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 11 == 0 else ("hot" if i % 10 < 7 else f"s{i % 4}"), base + dt.timedelta(seconds=13 * i)) for i in range(20000)]
    df = spark.createDataFrame(rows, "event_id long, source_id string, ts timestamp").withColumn("tenant_id", F.lit("t"))
    for order in ("event_id", "ts"):
        got = latest_per_source(df, order, limit)
        ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("tenant_id", "source_id").orderBy(F.col(order).desc()))).filter(F.col("rn") <= limit)
        assert sorted((r["event_id"], r["rn"]) for r in got.collect()) == sorted((r["event_id"], r["rn"]) for r in ref.collect())


def test_xml_artifact_without_fields(spark, tmp_path):
    d = tmp_path / "empty" / "tenant_id=t" / "artifact=schema_x_20260101_000000.xml"
    d.mkdir(parents=True)
    (d / "part-0.xml").write_text('<LogSchema tenant="t" type="x"/>\n')
    rows = read_schema_artifacts(spark, str(tmp_path / "empty")).collect()
    assert len(rows) == 1 and rows[0]["tenant"] == "t" and rows[0]["log_type"] == "x"
    assert rows[0]["name"] is None and rows[0]["pos"] is None
