import corpus_pipeline
import __spark_entry__ as se
from signals.llm.common import stored
from tests.conftest import SF001
from tests.llm import data


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF001), f"test-{name}")
        counts.append(docs.count())
        if name == "pii":
            assert docs.where("n_chars <> char_length(text)").count() == 0 and docs.where("text like '%[EMAIL]%'").count() > 0
        assert docs.columns[: len(columns)] == columns
    assert counts[0] > counts[1] > counts[2] == counts[3]
    assert docs.where("not decodes").count() == 0
    assert se.queries()["pipeline"](spark, SF001).count() == counts[-1]


def test_odd_and_empty_documents(spark, tmp_path):
    for name, docs in (("odd", data.odd(spark)), ("empty", data.empty(spark))):
        folder = data.write(spark, tmp_path / name, docs)
        rows = corpus_pipeline.run(spark, folder).collect()
        assert all(r["doc_id"] is None or r["doc_id"] in (6, 8, 9) for r in rows)
        assert all(r["size"] == r["target"] == r["part"] == "x" and r["decodes"] for r in rows) and (rows or name == "empty")
