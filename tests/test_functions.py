"""Scalar helpers S1-S17."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from signals.functions.text import (
    base_name,
    decode_replace,
    iso_local,
    json_or_error,
    literal_split,
    preview_json,
    py_strip,
    safe_module_name,
    split_first,
    thousands,
)
from signals.operators.schema import artifact_name


def test_string_helpers(spark):
    df = spark.createDataFrame([("a.b.c", " 　x y\x1f ", "tenants/acme/artifacts/parsers/s.xml", "ml/detect")], "s string, w string, p string, m string")
    k, v = split_first(F.col("s"), ".")
    r = df.select(
        literal_split(F.col("s"), ".").alias("parts"), k.alias("k"), v.alias("v"), py_strip(F.col("w")).alias("w"),
        base_name(F.col("p")).alias("b"), safe_module_name(F.col("m")).alias("m"),
    ).first()
    assert r["parts"] == ["a", "b", "c"] and (r["k"], r["v"]) == ("a", "b.c") and r["w"] == "x y"
    assert r["b"] == "s.xml" and r["m"] == "ml_detect"


def test_decode_and_formats(spark):
    df = spark.createDataFrame([(bytearray(b"ok\xff"), dt.datetime(2026, 2, 27, 14, 40, 29, 5), 1234567)], "b binary, ts timestamp, n long")
    r = df.select(
        decode_replace(F.col("b")).alias("d"), iso_local(F.col("ts")).alias("iso"), thousands(F.col("n")).alias("t"),
        artifact_name(F.lit("event"), F.col("ts")).alias("a"),
    ).first()
    assert r["d"] == "ok�" and r["iso"] == "2026-02-27T14:40:29.000005+00:00"
    assert r["t"] == "1,234,567" and r["a"] == "schema_event_20260227_144029.xml"


def test_preview_json_matches_js_layout(spark):
    df = spark.createDataFrame([({"q": 'x"y'},), ({},), (None,), ({"a": "1", "b": "é"},)], "m map<string,string>")
    got = [r["j"] for r in df.select(preview_json(F.col("m")).alias("j")).collect()]
    assert got[0] == json.dumps({"q": 'x"y'}, indent=2) and got[1] == "{}" and got[2] is None
    assert json.loads(got[3]) == {"a": "1", "b": "é"} and got[3].startswith('{\n  "') and got[3].endswith('"\n}')


def test_json_or_error(spark):
    df = spark.createDataFrame([('{"trained_pct": 12.5, "data_points": 3}',), ("{oops",), (None,)], "s string")
    rows = df.select(json_or_error(F.col("s"), "trained_pct double, data_points long", "metric read error").alias("j")).collect()
    assert rows[0]["j"]["trained_pct"] == 12.5 and rows[0]["j"]["_error"] is None
    assert rows[1]["j"]["trained_pct"] is None and rows[1]["j"]["_error"].startswith("metric read error")
    assert rows[2]["j"]["_error"] is None


def test_recommended_conf_sizes_partitions():
    from signals.session import recommended_conf

    small = recommended_conf(10 << 20, 8)
    big = recommended_conf(100 << 40, 8000)  # 100 TB on 8,000 cores
    assert small["spark.sql.shuffle.partitions"] == "24"
    assert int(big["spark.sql.shuffle.partitions"]) == 524288 and big["spark.sql.adaptive.enabled"] == "true"
