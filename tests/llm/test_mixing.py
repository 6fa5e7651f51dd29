import itertools

import numpy as np

from signals.llm.mixing import fill, mix, mixed, targets
from signals.llm.q_mixing import op8_mixing
from tests.conftest import SF001, SF0001
from tests.llm import data


def test_targets():
    assert targets([60, 60, 60]) == [30.0, 60.0, 90.0]
    t = targets([1000, 10, 10])
    assert t == [960.0, 30.0, 30.0] and sum(t) == 1020
    assert targets([]) == [] and targets([0, 0]) == [0.0, 0.0]


def test_fill_is_best_possible():
    r = np.random.default_rng(1)
    for _ in range(200):
        n = int(r.integers(1, 5))
        lengths = np.sort(r.choice(np.arange(1, 40), n, replace=False)).astype(np.int64)
        counts = r.integers(1, 4, n).astype(np.int64)
        budget = int(r.integers(0, (lengths * counts).sum() + 1))
        got = fill(lengths, counts, budget)
        assert (got >= 0).all() and (got <= counts).all()
        even = counts * budget // int((lengths * counts).sum())
        sums = [int((np.array(c) * lengths).sum()) for c in itertools.product(*[range(e, k + 1) for e, k in zip(even, counts)])]
        assert abs(int((got * lengths).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_fill_is_best_possible_beyond_the_window():
    lengths, counts = np.array([300, 200_000], np.int64), np.array([1000, 1], np.int64)
    assert int((fill(lengths, counts, 450_000) * lengths).sum()) == 470_000
    r = np.random.default_rng(2)
    for _ in range(15):
        n = int(r.integers(1, 4))
        lengths = np.sort(r.choice(np.arange(20_000, 200_000), n, replace=False)).astype(np.int64)
        counts = r.integers(1, 3, n).astype(np.int64)
        total = int((lengths * counts).sum())
        budget = int(r.integers(0, total + 1))
        got = fill(lengths, counts, budget)
        even = counts * budget // total
        sums = [int((np.array(c) * lengths).sum()) for c in itertools.product(*[range(e, k + 1) for e, k in zip(even, counts)])]
        assert (got >= 0).all() and (got <= counts).all()
        assert abs(int((got * lengths).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_query_meets_targets_and_reruns_agree(spark):
    a, b = (op8_mixing(spark, SF0001).toPandas().sort_values("doc_id").reset_index(drop=True) for _ in range(2))
    assert a.equals(b)
    assert (a["taken"] <= 3 * a["size"]).all() and (a["taken"] % a["size"].clip(lower=1) == 0).all()
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "source").toPandas()
    by = a.merge(docs, on="doc_id").groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), words=("size", "sum"), source_size=("source_size", "first"))
    assert (by["words"] == by["source_size"]).all()
    assert ((by["taken"] - by["target"]).abs() <= 0.01 * by["target"]).all()  # ten documents a source
    assert abs(by["target"].sum() - by["words"].sum()) < 1e-6


def test_many_documents_meet_targets_to_the_word(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "source")
    by = op8_mixing(spark, SF001).join(docs, "doc_id").groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= 0.5 for r in by)


def test_odd_rows_and_empty_table(spark, tmp_path):
    rows = op8_mixing(spark, data.write(spark, tmp_path / "odd", data.odd(spark))).collect()
    assert len(rows) == len(data.rows())
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert op8_mixing(spark, data.write(spark, tmp_path / "empty", data.empty(spark))).count() == 0


def test_mixed_repeats_rows(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a" if i < 90 else "c") for i in range(100)], "doc_id long, text string, source string")
    out = mixed(docs)
    assert out.columns == docs.columns
    by = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert by == {"a": 70, "c": 30}  # c stops at three times its size
    assert mix(docs).where("source = 'c' and copies <> 3").count() == 0


def test_mixed_keeps_columns_called_as_its_own(spark):
    rows = [(i, "w " * 10, "a" if i < 9 else "c", f"s{i}", i / 2, i % 3) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, target double, copies long")
    out = mixed(docs)
    assert out.columns == docs.columns
    own = {r[0]: r for r in rows}
    assert all(tuple(r) == own[r["doc_id"]] for r in out.collect())
    odd = data.odd(spark)
    assert {r["size"] for r in mixed(odd).collect()} == {"x"} and mixed(odd).columns == odd.columns
