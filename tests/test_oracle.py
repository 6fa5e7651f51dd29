"""Every registered query equals its DuckDB oracle (the driver's gate), at sf0.001 and on a few at sf0.01."""

from __future__ import annotations

import pytest

import __spark_entry__ as se
from signals.plans.registry import ORACLES, QUERIES, load_all
from tests.conftest import SF0001, SF001
from tools.oracle_check import duck, rows_of

load_all()  # the library's own; the operators of signals.llm have their tests beside them


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = {"f5_isolation_forest", "f6_reconstruction_score"}
    missing = set(QUERIES) - set(ORACLES) - rows_only
    assert not missing, missing


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["tenant_id", "user", "n", "window_start", "window_end"] or set(df.columns) == {
        "tenant_id", "user", "n", "window_start", "window_end"
    }


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle_sf0001(spark, name):
    con = duck(SF0001)
    got = QUERIES[name](spark, SF0001).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", ["f2_threshold", "c1_kv_parse", "d1_infer_schema", "a3_byte_offset", "f8_risk_scores"])
def test_query_matches_oracle_sf001(spark, name):
    con = duck(SF001)
    got = QUERIES[name](spark, SF001).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert rows_of(got) == rows_of(want)


def test_result_types_match_oracle_types(spark):
    from tools.type_check import SPARK_TO_DUCK

    con = duck(SF0001)
    bad = {}
    for name in sorted(ORACLES):
        st = {f.name: f.dataType.simpleString() for f in QUERIES[name](spark, SF0001).schema.fields}
        dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({ORACLES[name]})").fetchall()}
        diffs = [c for c in set(st) | set(dt) if SPARK_TO_DUCK.get(st.get(c), st.get(c)) != dt.get(c)]
        if diffs:
            bad[name] = diffs
    assert not bad, bad
