"""Plan shapes the scale design relies on."""

from __future__ import annotations

import datetime as dt
import re

import pytest

import __spark_entry__ as se
from tests.conftest import SF001


@pytest.fixture(scope="module")
def plan(spark):
    qs = se.queries()

    def get(name: str) -> str:
        return qs[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()

    return get


def shuffles(p: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", p))


@pytest.mark.parametrize("name", ["c1_kv_parse", "c5_parse_header", "c6_apply_schema", "f1_rules", "f11_grep_documents", "f12_route_documents", "b1_stamp"])
def test_row_operators_do_not_shuffle(plan, name):
    assert shuffles(plan(name)) == 0


def test_threshold_is_one_partial_aggregate(plan):
    p = plan("f2_threshold")
    assert shuffles(p) == 1 and "partial_count" in p


def test_topk_plans(plan):
    assert "TakeOrderedAndProject" in plan("b2_latest_global")
    assert "TakeOrderedAndProject" in plan("f9_top_risks")
    assert plan("b3_latest_per_source").count("WindowGroupLimit") == 2  # partial before the shuffle + final


@pytest.mark.parametrize("name", ["e3_entitled", "f10_unmatched"])
def test_config_joins_broadcast(plan, name):
    p = plan(name)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p and shuffles(p) == 0


@pytest.mark.parametrize("name", ["a1_read_logs", "a3_byte_offset"])
def test_lines_are_numbered_in_one_scan_without_python(spark, name):
    df = se.queries()[name](spark, SF001)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "MapInPandas" not in p and "Python" not in p
    # the table of splits takes the shuffle of the lines instead of reading the text again
    assert p.count("FileScan text") == 1 and p.count("ReusedExchange") == 1


def test_inference_aggregates_before_shuffle(plan):
    p = plan("d1_infer_schema")
    assert "partial_count" in p and "Generate posexplode" in p


def test_tenant_filter_after_normalize_prunes_partitions(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from signals.operators.parse import normalize, parse_header
    from signals.session import scratch_path
    from signals.sources.zones import read_zone, write_zone

    root = scratch_path(spark, "prune")
    rows = [("acme", dt.datetime(2024, 1, 1), "<14>1 2024-01-01T00:00:00 [deny] [1.2.3.4] tcpflag=SYN"),
            ("bravo", dt.datetime(2024, 1, 2), "<14>1 2024-01-02T00:00:00 [deny] [1.2.3.4] tcpflag=ACK")]
    write_zone(spark.createDataFrame(rows, "tenant_id string, ts timestamp, raw_data string"), root, "data/raw", date_col="ts")
    parsed = normalize(parse_header(read_zone(spark, root, "data/raw")), {"type": "kv"}, input_col="body")
    q = parsed.filter((F.col("tenant_id") == "acme") & (F.col("parsed")["tcpflag"] == "SYN"))
    p = q._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*tenant_id", p)  # the tenant filter reached the scan
    assert p.count("array_sort(") == 1  # the map is computed once, the parsed-value filter stays above it
    assert q.count() == 1


def test_large_ring_ranks_only_candidate_buckets(plan):
    # per-source ring of 2000 (> Spark's window group limit threshold of 1000): the window sees only
    # the rows of the buckets that overlap the newest 2000 (a left semi join), not the whole source
    p = plan("b4_retain_latest")
    assert "LeftSemi" in p and "TakeOrderedAndProject" in p


def executed(df) -> str:
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    return p[: p.index("== Initial Plan ==")] if "== Initial Plan ==" in p else p


@pytest.mark.parametrize("name", ["f8_risk_scores", "f9_top_risks"])
def test_scores_read_the_log_once(spark, name):
    p = executed(se.queries()[name](spark, SF001))
    assert p.count("FileScan") == 1 and "ReusedExchange" in p


def test_top_risks_filters_its_tenant_at_the_scan(plan):
    p = plan("f9_top_risks")
    at = p.index("FileScan")
    # tenant = 'acme' is a test of the id that its name is made from
    assert "% 3" in p[p.rindex("Filter", 0, at) : at]


def test_explain_shuffles_nothing_row_sized(spark):
    p = executed(se.queries()["f7_explain"](spark, SF001))
    # the features' aggregation is shared; what follows it is a one-row aggregate
    assert "Window" not in p and "BroadcastNestedLoopJoin" in p


def test_landed_blocks_lie_in_one_folder(spark, tmp_path):
    """A file for each block, not a folder: folders are listed in a task each."""
    import glob
    import os

    from signals.plans.q_sources import log_files
    from signals.session import local_path

    ids = [None, 7000, -1, 2500] + [i for i in range(5000) if i % 7] + [2500]  # a null, a negative and repeated ids
    rows = [(i, dt.datetime(2024, 1, 1), None if i == 3 else 5, "view", 1.5, "{}") for i in ids]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    root = local_path(spark, log_files(spark, str(tmp_path)))
    files = glob.glob(f"{root}/**/*.txt", recursive=True)
    assert len(files) == 8 and {os.path.dirname(f) for f in files} == {root}
    assert not [f for f in os.listdir(root) if f.startswith(".")]
    text = {tuple(re.findall(r"bytes=(-?\d+)|^()$", open(f).read()[:-1], re.M)) for f in files}
    blocks = {}
    for i in ids:
        blocks.setdefault(None if i is None else i // 1000, []).append(i)
    want = [[("", "") if i is None or i == 3 else (str(i), "") for i in sorted(b, key=lambda i: i or 0)] for b in blocks.values()]
    assert text == {tuple(w) for w in want}


def test_lines_are_split_in_compiled_code(plan):
    p = plan("a3_byte_offset")
    assert "lambda" not in p and "Generate posexplode" in p
