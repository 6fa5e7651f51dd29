"""Parsing operators (C1-C6) against Python models and the fixture edge lines."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signals.functions.text import JS_WHITESPACE, PY_WHITESPACE, java_quote
from signals.operators.parse import (
    apply_schema,
    extract,
    kv_parse,
    normalize,
    optional_groups,
    parse_header,
    regex_parse,
    split_quarantine,
)
from tests.models import kv_model, kv_preview_model, normalize_model, regex_model


def _run(spark, lines, col):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, s string")
    return {r["i"]: r["m"] for r in df.select("i", col.alias("m")).collect()}


EDGE = [
    ("", {}),
    ("a=1 a=2", {"a": "2"}),
    ("=x y=", {"": "x", "y": ""}),
    ("k=v=w", {"k": "v=w"}),
    ("nosep z=1", {"z": "1"}),
    (" a =  b", {"": ""}),
    ("\tk =v  q=\x1cz", {"": "v", "q": "z"}),
    ("timestamp=2026-02-27 11:30:00 user=u", {"timestamp": "2026-02-27", "user": "u"}),
]


def test_kv_edge_lines(spark):
    got = _run(spark, [s for s, _ in EDGE], kv_parse(F.col("s")))
    for i, (line, want) in enumerate(EDGE):
        if line == "":
            continue  # empty input is handled by normalize (C4), see below
        assert dict(got[i]) == want, line


def test_kv_preview_drops_empty_key(spark):
    got = _run(spark, ["=x y=", "\tk =v  q=\x1cz"], kv_parse(F.col("s"), drop_empty_keys=True, whitespace=JS_WHITESPACE))
    assert dict(got[0]) == {"y": ""}
    assert dict(got[1]) == kv_preview_model("\tk =v  q=\x1cz")


ALPHABET = st.sampled_from(list("ab=:;|. \t\n\\Eq$^*") + ["\xa0", "　", "\x1c", "é"])
PIECES = st.lists(st.sampled_from(["\\E", "==", "a=b", " = ", "k=v=w"]) | st.text(alphabet=ALPHABET, max_size=6), max_size=8)
LINES = st.lists(PIECES.map("".join), min_size=1, max_size=25)
SEPS = [("=", " "), (":", ";"), ("==", "|"), (".", "\\E"), ("$", "^*"), ("=", "\n"), ("\\", " ")]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=LINES, seps=st.sampled_from(SEPS))
def test_kv_matches_python_model(spark, lines, seps):
    sep, delim = seps
    got = _run(spark, lines, kv_parse(F.col("s"), separator=sep, delimiter=delim))
    for i, line in enumerate(lines):
        assert dict(got[i]) == kv_model(line, sep, delim), (line, sep, delim)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=LINES)
def test_kv_preview_matches_js_model(spark, lines):
    got = _run(spark, lines, kv_parse(F.col("s"), drop_empty_keys=True, whitespace=JS_WHITESPACE))
    for i, line in enumerate(lines):
        assert dict(got[i]) == kv_preview_model(line), line


def test_whitespace_sets():
    assert set(PY_WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert java_quote("a\\Eb") == "\\Qa\\E\\\\E\\Qb\\E"


REGEX_CASES = [
    (r"^\[(.*?)\] (.*)$", ["a", "b"]),
    (r"user=(\w+)(?: id=(\d+))?", ["user", "id"]),
    (r"(x)|(y)", ["x", "y"]),
    (r"(?P<k>\w+)=(?P<v>\w*)", ["k", "v", "extra"]),
    (r"(\d+)-(\d+)", ["n"]),
    (r"(a)(b)?", ["f", "f"]),
    ("", ["a"]),
    (r"(\d+)\s(\w+)", ["n", "w"]),
    (r"^(.+)$", ["line"]),
    (r"(?i)(ÉTÉ)", ["s"]),
    (r"(?P<w>\w+)\Z", ["w"]),
    (r"(?P<a>[a-z])(?P=a)", ["a"]),
    (r"(b{,2})a", ["bs"]),
    (r"(?x) (\w) (\d*)  # a letter, digits", ["c", "n"]),
    (r"(?s)(.)(\n)?$", ["c", "end"]),
    (r"(?<=q)=(.)", ["v"]),
    (r"(\w+)?=?(\$\d)?", ["k", "cost"]),
]
REGEX_LINES = [
    "[t] body", "user=bob id=7", "user=al", "y", "x", "k=", "12-34", "a", "ab", "zzz", "[] ", "q=1 r=2",
    "x ٣٤\u3000naïve", "a\rb", "tail\n", "été", "aab", "bba", "word\n", "a\x01b=\x01 1-2", "\x01", "cost=$1 \\1", "x1\n\n",
]


@pytest.mark.parametrize("pattern,fields", REGEX_CASES)
def test_regex_matches_python_model(spark, pattern, fields):
    got = _run(spark, REGEX_LINES, regex_parse(F.col("s"), pattern, fields))
    for i, line in enumerate(REGEX_LINES):
        assert dict(got[i]) == regex_model(line, pattern, fields), (pattern, line)


def test_groups_are_read_in_one_scan(spark):
    df = spark.createDataFrame([("a=1",)], "s string")
    m = regex_parse(F.col("s"), r"(\w)=(\w)(\w)?(\w)?(\w)?(\w)?(\w)?(\w)?", list("abcdefgh"))
    plan = df.select(m.alias('m'))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1


EXTRACT_RULES = [
    {"type": "kv"}, {"type": "kv", "delimiter": "|"}, {"type": "kv", "separator": "==", "delimiter": ","}, {"type": "kv", "separator": " ", "delimiter": " "},
    {"type": "kv", "delimiter": None}, {"type": "kv", "delimiter": "||"}, {"type": "kv", "separator": ""}, {"type": "kv", "delimiter": "=", "separator": "="},
    {"type": "regex", "pattern": r"(\w)=(\w)", "fields": ["a", "b"]}, {"type": "xml"},
]
EXTRACT_KEYS = ["a", "", "b", "a=", "ab", " a", "é", "a|b"]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(st.text(alphabet=" =|,ab1é\t\u2003", max_size=24), min_size=1, max_size=40))
def test_extract_equals_the_whole_parse(spark, lines):
    df = spark.createDataFrame([(s,) for s in [*lines, None, ""]], "raw_data string")
    for rule in EXTRACT_RULES:
        both = extract(normalize(df, rule, output_col="whole"), rule, EXTRACT_KEYS)
        for r in both.collect():
            want = {k: (r["whole"] or {}).get(k) for k in EXTRACT_KEYS}
            assert r["parsed"].asDict() == want, (rule, r["raw_data"])


def test_extract_spares_the_whole_parse(spark):
    """Plain lines are searched: the general parse stands behind a condition and a generator."""
    df = spark.createDataFrame([("a=1 b=2 a=3",), ("a=1\tb=2",)], "raw_data string")
    out = extract(df, {"type": "kv"}, ["a", "b"])
    assert [tuple(r["parsed"]) for r in out.collect()] == [("3", "2"), ("1\tb=2", None)]
    typed = apply_schema(out, [("a", "integer")])
    assert [(r["record"]["a"], r["cast_errors"]) for r in typed.collect()] == [(3, []), (None, ["a"])]


def test_optional_groups():
    assert optional_groups(r"(a)(b)?") == {2}
    assert optional_groups(r"(x)|(y)") == {1, 2}
    assert optional_groups(r"((a)*)b") == {2}


RULES = [
    {"type": "kv"},
    {"type": "kv", "separator": ":", "delimiter": ","},
    {"type": "kv", "separator": ""},
    {"type": "kv", "delimiter": ""},
    {"type": "regex", "pattern": r"(\w+)=(\w+)", "fields": ["k", "v"]},
    {"type": "regex", "pattern": ""},
    {"type": "regex", "pattern": "(unclosed", "fields": ["a"]},
    {"type": "xml"},
    {},
]


@pytest.mark.parametrize("rule", RULES)
def test_normalize_outcomes(spark, rule):
    lines = [None, "", "a=1 b=2", "k:v,x:y", "nothing here", "  "]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, raw_data string")
    rows = {r["i"]: r for r in normalize(df, rule).collect()}
    for i, line in enumerate(lines):
        want = normalize_model(line, rule)
        got = rows[i]["parsed"]
        assert (None if got is None else dict(got)) == want, (rule, line)
        status = "error" if want is None else ("empty" if want == {} else "parsed")
        assert rows[i]["parse_status"] == status


def test_split_quarantine(spark):
    df = spark.createDataFrame([("a=1",), ("",)], "raw_data string")
    good, bad = split_quarantine(normalize(df, {"type": "nope"}))
    assert good.count() == 1 and bad.count() == 1


def test_parse_header(spark):
    lines = [
        "<14>1 2026-02-26T17:15:12.892665+09:00 [deny] [192.168.105.10] srcip=1.2.3.4 dstip=5.6.7.8",
        "<14>1 2024-01-01T00:00:07 [event] [10.0.0.1] user=u",
        "<14>1 2024-01-01T00:00:07 [event] [10.0.0.1]",
        "garbage",
        "<14>1 2024-01-01T00:00:07 [alert type] [10.0.0.1] ",
        "<1234>1 2024-01-01T00:00:07 [event] [10.0.0.1] x",
    ]
    df = spark.createDataFrame([(s,) for s in lines], "raw_data string")
    rows = parse_header(df).withColumn("t", F.col("event_time").cast("string")).collect()
    assert rows[0]["pri"] == 14 and rows[0]["version"] == 1 and rows[0]["log_type"] == "deny"
    assert rows[0]["t"] == "2026-02-26 08:15:12.892665"  # offset applied, session time zone UTC
    assert rows[0]["body"] == "srcip=1.2.3.4 dstip=5.6.7.8"
    assert rows[1]["t"] == "2024-01-01 00:00:07" and rows[1]["sender_ip"] == "10.0.0.1"
    assert rows[2]["body"] is None and rows[2]["log_type"] == "event"
    assert rows[3]["pri"] is None and rows[3]["event_time"] is None
    assert rows[4]["log_type"] == "alert type" and rows[4]["body"] == ""
    assert rows[5]["log_type"] is None  # PRI has at most 3 digits


def test_apply_schema_types_and_errors(spark):
    df = spark.createDataFrame(
        [({"t": "2024-01-02 03:04:05", "ip": "10.0.0.256", "n": "42", "s": "x"},), ({"t": "bad", "n": "4.2"},)],
        "parsed map<string,string>",
    )
    out = apply_schema(df, [("t", "datetime"), ("ip", "ip_address"), ("n", "integer"), ("s", "string")]).collect()
    r0, r1 = out
    assert str(r0["record"]["t"]) == "2024-01-02 03:04:05" and r0["record"]["n"] == 42
    assert r0["record"]["ip"] is None and r0["cast_errors"] == ["ip"]
    assert r1["cast_errors"] == ["t", "n"] and r1["record"]["s"] is None


def _ordered_items(spark, lines, col):
    """Map entries in map order (collect() turns maps into hash maps; arrays keep the order)."""
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, s string")
    rows = df.select("i", col.alias("m")).select("i", F.map_keys("m").alias("k"), F.map_values("m").alias("v")).collect()
    return {r["i"]: list(zip(r["k"], r["v"])) for r in rows}


def test_kv_first_seen_order(spark):
    got = _ordered_items(spark, ["b=1 a=2 b=3 c=4 a=5", "", "z=1"], kv_parse(F.col("s"), first_seen_order=True))
    assert got[0] == [("b", "3"), ("a", "5"), ("c", "4")]
    assert got[1] == [] and got[2] == [("z", "1")]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=LINES, seps=st.sampled_from(SEPS))
def test_kv_first_seen_order_matches_dict_order(spark, lines, seps):
    sep, delim = seps
    got = _ordered_items(spark, lines, kv_parse(F.col("s"), separator=sep, delimiter=delim, first_seen_order=True))
    for i, line in enumerate(lines):
        assert got[i] == list(kv_model(line, sep, delim).items()), (line, sep, delim)


def _js_preview_model(raw: str, sep: str = "=", delim: str = " ") -> str:
    import json

    d = kv_preview_model(raw, sep, delim)
    idx = sorted((k for k in d if k.isdigit() and k.isascii() and (k == "0" or not k.startswith("0")) and int(k) < 2**32 - 1), key=int)
    rest = [k for k in d if k not in idx]
    return json.dumps({k: d[k] for k in idx + rest}, indent=2, ensure_ascii=False) if d else "{}"


PREVIEW_ALPHABET = st.sampled_from(list("ab0129=:. \t\"\\é"))
PREVIEW_LINES = st.lists(st.text(alphabet=PREVIEW_ALPHABET, max_size=12), min_size=1, max_size=20)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=PREVIEW_LINES)
def test_kv_preview_json_matches_js(spark, lines):
    from signals.operators.parse import kv_preview_json

    got = _run(spark, lines, kv_preview_json(F.col("s")))
    for i, line in enumerate(lines):
        assert got[i] == _js_preview_model(line), line


REGEX_RULES = [
    (r"user=(\w+)(?: id=(\d+))?", ["user", "id"]),
    (r"^(\S+) (\S+)$", ["a", "b", "c"]),
    (r"(a+)|(b+)", ["as", "bs"]),
    (r"(?P<k>[^=\s]+)=(?P<v>[^=\s]*)", ["k", "v"]),
]
RX_ALPHABET = st.sampled_from(list("ab=id7 \txé٣\n") + ["user=", " id="])
RX_LINES = st.lists(st.lists(RX_ALPHABET, max_size=10).map("".join), min_size=1, max_size=15)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=RX_LINES, rule=st.sampled_from(REGEX_RULES))
def test_regex_matches_python_model_generated(spark, lines, rule):
    pattern, fields = rule
    got = _run(spark, lines, regex_parse(F.col("s"), pattern, fields))
    for i, line in enumerate(lines):
        assert dict(got[i]) == regex_model(line, pattern, fields), (pattern, line)


NORMALIZE_RULES = st.sampled_from(RULES)
NORMALIZE_LINES = st.lists(st.one_of(st.none(), st.just(""), PIECES.map("".join)), min_size=1, max_size=12)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=NORMALIZE_LINES, rule=NORMALIZE_RULES)
def test_normalize_matches_python_model_generated(spark, lines, rule):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, raw_data string")
    rows = {r["i"]: r for r in normalize(df, rule).collect()}
    for i, line in enumerate(lines):
        want = normalize_model(line, rule)
        got = rows[i]["parsed"]
        assert (None if got is None else dict(got)) == want, (rule, line)
