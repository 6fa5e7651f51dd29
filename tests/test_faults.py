"""Cases where a plain fixture shows nothing: other time zones, long gaps, ids like numbers, nulls, groups in patterns."""

from __future__ import annotations

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from signals.operators.anomaly import explain, feature_stats, isolation_forest_fit
from signals.operators.detect import detect_syn_flood, detect_threshold, entity_features
from signals.operators.grep import grep_match
from signals.operators.parse import kv_parse
from signals.operators.response import assign_responses, first_responses, policy_table
from signals.operators.risk import risk_scores
from signals.operators.schema import history_rows, revise_schema, current_schema
from signals.operators.tenancy import eps_violations, limits_table, source_status
from signals.session import scratch_path, shared_dir
from signals.sources.artifacts import read_schema_artifacts, schema_fields
from signals.sources.files import read_logs
from signals.sources.metrics import read_training_metrics
from tests.test_streaming import _rows, _run


def _landed(spark, batches, schema):
    """One file per batch, read one per trigger in this order."""
    path = scratch_path(spark, "faults")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path), spark.read.parquet(path)


DETECTION = "tenant_id string, entity string, rule string, event_id long, event_time timestamp_ntz"


def test_first_response_once_per_window_with_defaults(spark):
    """Detections of one day, farther apart than the watermark, give one action."""
    at = lambda d, h, m: dt.datetime(2024, 1, d, h, m)
    times = [at(2, 0, 30), at(2, 5, 10), at(2, 11, 0), at(2, 23, 50), at(3, 0, 10), at(3, 9, 0), at(5, 1, 0)]
    batches = [[("acme", "u1", "R", i, t)] for i, t in enumerate(times)]
    stream, batch = _landed(spark, batches, DETECTION)
    policy = policy_table(spark, {"R": "Block_IP"})
    cols = ["tenant_id", "entity", "action", "window_start"]
    got = _rows(_run(first_responses(stream, policy), "once_a_window", "append"), cols)
    assert got == _rows(assign_responses(batch, policy)[0], cols) and len(got) == 3


@pytest.fixture(params=["Asia/Seoul", "America/New_York"])
def zone(spark, request):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", old)


def test_streams_equal_batch_in_other_zones(spark, zone):
    """Wall-clock days around a change to summer time (10 March 2024 in New York)."""
    rows = []
    for day in (9, 10, 11):
        for hour in (0, 1, 2, 3, 12, 23):
            rows.append(("acme", "u1", "R", len(rows), dt.datetime(2024, 3, day, hour, 30)))
    # as the event time is a wall clock, 02:30 on the 10th is a time like any other
    last = [("acme", "zz", "none", 999, dt.datetime(2024, 3, 20))]
    stream, batch = _landed(spark, [rows[:9], rows[9:], last, last], DETECTION)
    name = zone.replace("/", "_").lower()

    def same(make, cols, label):
        want = [r for r in _rows(make(batch), cols) if r[0] != "zz" and r[1] != "zz"]
        got = [r for r in _rows(_run(make(stream), f"{label}_{name}", "append"), cols) if r[0] != "zz" and r[1] != "zz"]
        assert got == want and want, label

    same(lambda d: detect_threshold(d, ["entity"], "event_time", "1 day", 1), ["entity", "window_start", "window_end", "n"], "f2")
    flags = lambda d: d.withColumns({"dstip": F.col("entity"), "srcip": F.lit("s"), "tcpflag": F.lit("SYN"), "packets": F.lit(1)})
    same(lambda d: detect_syn_flood(flags(d), "event_time", 1, "1 day"), ["dstip", "window_start", "syn_packets"], "f3")
    same(lambda d: entity_features(d, "entity", "event_time", type_col="rule", types=["R"], value_col=None), ["entity", "window_start", "n_events", "n_hours", "first_hour"], "f4")
    policy = policy_table(spark, {"R": "Block_IP", "none": "Nothing"})
    same(lambda d: assign_responses(d, policy)[0], ["entity", "action", "window_start", "n_detections"], "f10")
    limits = limits_table(spark, {"acme": (0.00001, 1)})
    eps = lambda d: eps_violations(d.where("rule = 'R'"), limits, "event_time", per="1 day")
    want = _rows(eps(batch), ["tenant_id", "window_start", "n_events"])
    got = _rows(_run(eps(stream), f"e5_{name}", "append"), ["tenant_id", "window_start", "n_events"])
    assert want and set(got) <= set(want)  # the last window stays open: its filter holds back later rows


def test_grep_groups_and_python_classes(spark):
    df = spark.createDataFrame([("a11b",), ("xx",), ("١",), ("none",), (None,)], "t string")
    hit = lambda p, mode="any": [r[0] for r in df.select(grep_match("t", p, mode)).collect()]
    assert hit([r"([a-z])\1", r"([0-9])\1"]) == [True, True, False, False, False]
    assert hit([r"(?P<d>[0-9])(?P=d)", r"(?P<d>q)"]) == [True, False, False, False, False]
    assert hit([r"([a-z])\1", r"([0-9])\1"], "none") == [False, False, True, True, True]
    assert hit([r"\d"]) == [True, False, True, False, False]  # as in Python, any decimal digit


def test_null_delimiter_splits_like_python(spark):
    text = "  a=1\t b=2\n\nc = 3 d=4\x1ce=5　f=6 "
    got = spark.createDataFrame([(text,)], "t string").select(kv_parse("t", "=", None)).first()[0]
    want = {}
    for p in text.split(None):
        if "=" in p:
            k, _, v = p.partition("=")
            want[k.strip()] = v.strip()
    assert got == want


def test_offsets_of_compressed_files(spark, tmp_path):
    with gzip.open(tmp_path / "a.log.gz", "wb") as f:
        f.write(b"".join(b"line number %08d\n" % i for i in range(50)))
    rows = read_logs(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [r["offset"] for r in rows] == [21 * (i + 1) for i in range(50)]


def test_schema_fields_of_flat_files(spark, tmp_path):
    (tmp_path / "schema_t_20240101_000000.xml").write_text('<LogSchema tenant="a" type="t"><Field name="old" type="string"/></LogSchema>')
    (tmp_path / "schema_t_20240102_000000.xml").write_text('<LogSchema tenant="a" type="t"><Field name="x" type="integer"/></LogSchema>')
    a = read_schema_artifacts(spark, str(tmp_path))
    assert schema_fields(a, "a", "t") == [("x", "integer")]
    assert schema_fields(a, "a", "t", "schema_t_20240101_000000.xml") == [("old", "string")]


def test_artifact_tenants_are_strings(spark, tmp_path):
    d = tmp_path / "tenant_id=0042" / "artifact=7"
    d.mkdir(parents=True)
    (d / "part.xml").write_text('<LogSchema tenant="0042" type="t"><Field name="x"/></LogSchema>')
    r = read_schema_artifacts(spark, str(tmp_path)).first()
    assert r["tenant_id"] == "0042" and r["artifact"] == "7"


def test_metrics_of_a_new_root_are_defaults(spark, tmp_path):
    modules = spark.createDataFrame([("a", "m")], "tenant_id string, module_id string")
    for layout in ("partitioned", "files"):
        r = read_training_metrics(spark, str(tmp_path / "nothing"), modules, layout=layout).first()
        assert (r["trained_pct"], r["data_points"], r["last_trained_at"], r["last_error"]) == (0.0, 0, None, None)


def test_history_counts_beyond_int(spark):
    q = spark.createDataFrame([("a", "t", 99.5, 3_000_000_000)], "tenant_id string, log_type string, accuracy double, processed_count long")
    assert history_rows(q, "/r", F.lit(dt.datetime(2024, 1, 1)), "r").first()["processed_count"] == 3_000_000_000


def test_emptied_schema_can_be_filled_again(spark):
    cat = spark.createDataFrame([("a", "t", 1, 0, "x", "string", "100%")], "tenant_id string, log_type string, version int, pos int, name string, type string, confidence string")
    empty = revise_schema(cat, "a", "t", remove=[0])
    assert current_schema(empty).count() == 0
    again = current_schema(revise_schema(empty, "a", "t", add=1)).collect()
    assert [(r["version"], r["pos"], r["name"]) for r in again] == [(3, 0, "new_field")]


def test_status_ties_follow_the_order_columns(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", "s", t, n, n == 2, True, None, 1, "{}") for n in (1, 2, 3)]
    df = spark.createDataFrame(rows, "tenant_id string, source_id string, ts timestamp, batch long, running boolean, healthy boolean, error string, n_records long, config string")
    assert source_status(df, order=["batch"]).first()["running"] is False
    assert source_status(df.orderBy(F.desc("batch"))).first()["running"] is True  # without them: the greatest state, in any row order


def test_explain_puts_nulls_last_in_both_forms(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 5.0), ("c", 9.0, 6.0)], "k string, x double, y double")
    plain = explain(df, ["k"], ["x", "y"], n=2).orderBy("k", "rank").collect()
    given = explain(df, ["k"], ["x", "y"], n=2, stats=feature_stats(df, ["x", "y"])).orderBy("k", "rank").collect()
    assert plain == given and plain[1]["feature"] == "y" and plain[1]["z"] is None


def test_forest_members_by_whole_rows(spark):
    """An id column that isn't unique must not send all rows to one tree."""
    df = spark.range(3000).select(F.lit("acme").alias("tenant_id"), (F.col("id") * 1.0).alias("x"))
    model = isolation_forest_fit(df, ["x"], ["tenant_id"], trees=10, sample=256)
    sizes = {r["tree_id"]: r["n_sample"] for r in model.select("tree_id", "n_sample").distinct().collect()}
    assert len(sizes) == 10 and max(sizes.values()) < 512


def test_risk_sums_are_exact(spark):
    rows = [("t", "a", "x")] * 10 + [("t", "b", "y")]
    d = spark.createDataFrame(rows, "tenant_id string, entity string, severity string")
    got = {r["entity"]: (r["score"], r["rank"]) for r in risk_scores(d, {"x": 0.1, "y": 1.0}).collect()}
    assert got == {"a": (1.0, 1), "b": (1.0, 1)}


def test_no_silent_local_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_tenants_without_a_metrics_folder(spark, tmp_path):
    """Tenant folders exist, none has metrics: every metric has its defaults."""
    from signals.sources.metrics import read_training_metrics

    (tmp_path / "acme" / "artifacts").mkdir(parents=True)
    modules = spark.createDataFrame([("acme", "risk")], "tenant_id string, module_id string")
    want = [("acme", "risk", 0.0, 0, None, None)]
    assert [tuple(r) for r in read_training_metrics(spark, str(tmp_path), modules, layout="files").collect()] == want
    (tmp_path / "acme" / "metrics").mkdir()
    assert [tuple(r) for r in read_training_metrics(spark, str(tmp_path), modules, layout="files").collect()] == want
    (tmp_path / "acme" / "metrics" / "risk.json").write_text('{"trained_pct": 12.5, "data_points": 3}')
    assert [tuple(r)[2:4] for r in read_training_metrics(spark, str(tmp_path), modules, layout="files").collect()] == [(12.5, 3)]
