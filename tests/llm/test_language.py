import zlib

import numpy as np

from signals.llm import language
from signals.llm.q_language import op10_language
from tests.conftest import SF001
from tests.llm import data


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = op10_language(spark, SF001).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows_and_empty_table(spark, tmp_path):
    rows = op10_language(spark, data.write(spark, tmp_path / "odd", data.odd(spark))).collect()
    assert len(rows) == len(data.rows())
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (0, 1, 2))
    assert all(r["lang_pred"] in ("en", "de") for r in rows if r["doc_id"] in (6, 9))
    assert op10_language(spark, data.write(spark, tmp_path / "empty", data.empty(spark))).count() == 0
    unlabelled = data.odd(spark).drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r["lang_pred"] for r in op10_language(spark, data.write(spark, tmp_path / "none", unlabelled)).collect()} == {"und"}


def test_kernel_counts_shared_grams():
    a, b = (set(language.codes(t).tolist()) for t in ("Ab, cd", "ab!! CD"))
    assert a == b  # what isn't a letter is one space
    samples = [("x", np.unique(language.codes("aaa bbb"))), ("y", np.unique(language.codes("ccc ddd")))]
    m = language.Model(samples)
    place = m.table()
    k = m._kernels(m._sets([language.codes("aaa bbb")], place))[0]
    shared = len(set(samples[0][1].tolist()) & set(samples[1][1].tolist()))
    assert abs(k[0] - 1) < 1e-6 and abs(k[1] - shared / np.sqrt(len(samples[0][1]) * len(samples[1][1]))) < 1e-6
    best, _ = m.predict(["aab bba", "cdd dcc"], place)
    assert [m.langs[i] for i in best] == ["x", "y"]
