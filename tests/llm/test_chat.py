import __spark_entry__ as se
from signals.llm.chat import chat_format, maximal
from signals.llm.q_chat import op7_chat
from tests.conftest import SF001
from tools.oracle_check import duck, rows_of

SCHEMA = "conv_id long, turn long, role string, text string, rendered string"


def turns(*conversations):
    return [(c, i, "user" if i % 2 == 0 else "assistant", t, "x") for c, texts in conversations for i, t in enumerate(texts)]


def test_query_equals_sql(spark):
    got = op7_chat(spark, SF001).toPandas()
    assert rows_of(got) == rows_of(duck(SF001).execute(se.oracle_sql()["op7_chat"]).df())


def test_snapshots_and_copies(spark):
    rows = turns((1, ["a"]), (2, ["a", "b"]), (3, ["a", "b", "c"]), (4, ["a", "x"]), (5, ["a", "b", "c"]), (6, ["b"]))
    kept = {r["conv_id"]: (r["n_turns"], r["copies"]) for r in maximal(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept == {3: (3, 2), 4: (2, 1), 6: (1, 1)}


def test_long_conversations_cross_runs(spark):
    long = [f"t{i % 5}" for i in range(1000)]
    rows = turns((1, long), (2, long[:700]), (3, long[:512]), (4, [*long[:600], "other"]))
    kept = {r["conv_id"]: r["n_turns"] for r in maximal(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()}
    assert kept == {1: 1000, 4: 601}


def test_nulls_repeats_and_empty(spark):
    rows = [(1, None, None, None, "x"), (1, 0, "user", "a", "x"), (2, 0, "user", "a", "x"), (None, 0, "user", None, "x"), (None, 0, "user", None, "x"), (3, 0, "user", "", "x")]
    got = chat_format(spark.createDataFrame(rows, SCHEMA)).collect()
    # 2 prefixes 1; the null id's two equal rows are two turns; an empty text is not a null one
    assert sorted((str(r["conv_id"]), r["n_turns"]) for r in got) == [("1", 2), ("1", 2), ("3", 1), ("None", 2), ("None", 2)]
    assert {r["rendered"] for r in got if r["turn"] is None} == {"<|im_start|>\n<|im_end|>\n"}
    assert chat_format(spark.createDataFrame([], SCHEMA)).count() == 0


def test_native(spark):
    assert "Python" not in op7_chat(spark, SF001)._jdf.queryExecution().executedPlan().toString()
