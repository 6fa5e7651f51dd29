import re
from collections import Counter

import __spark_entry__ as se
from signals.llm.q_quality import op2_quality_rules
from signals.llm.quality_rules import METRICS, SYMBOLS, apply_rules, keep_good
from tests.conftest import SF0001
from tests.llm import data
from tools.oracle_check import duck, rows_of

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    windows = list(zip(w, w[1:], w[2:]))
    many = Counter(windows)
    covered = {p for i, x in enumerate(windows) if many[x] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(s) for s in SYMBOLS), len(lines) - len(set(lines)), len(covered))


def test_query_equals_sql(spark):
    got = op2_quality_rules(spark, SF0001).toPandas()
    want = duck(SF0001).execute(se.oracle_sql()["op2_quality_rules"]).df()
    assert rows_of(got) == rows_of(want)


def test_odd_rows(spark):
    for r in apply_rules(data.odd(spark)).collect():
        assert tuple(r[m] for m in METRICS) == brute(r["text"])
        assert not (r["kept"] and r["base_failed"])
        assert r["size"] == "x"
    assert apply_rules(data.empty(spark)).count() == 0
    assert keep_good(data.odd(spark)).columns == data.odd(spark).columns


def test_no_user_function_and_no_shuffle(spark):
    plan = op2_quality_rules(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_labels_agree(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = op2_quality_rules(spark, "/root/testdata/sf0.01").where("not base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    table = {(r["quality"], r["kept"]): r["count"] for r in seen}
    assert not table.get((1, False)) and not table.get((0, True))
