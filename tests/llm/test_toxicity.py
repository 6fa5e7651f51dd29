import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from signals.llm import toxicity, transducers
from signals.llm.q_toxicity import op13_toxicity
from signals.llm.transducers import KINDS, SYMBOLS
from tests.llm import data

PLAIN = toxicity.Model(toxicity.PRIOR, {})


def kinds(text):
    sums = PLAIN.sums(toxicity.lowered(text))
    return {} if sums is None else {k: v for k, v in zip(KINDS, sums.tolist()) if v}


@pytest.mark.parametrize(
    "text, want",
    [
        ("What an idiot that was", {"bare insult": 1}),
        ("You are such an IDIOT.", {"directed insult": 1}),
        ("idiot, shut it, you", {"directed insult": 1}),
        ("They are not idiots", {"negated insult": 1}),
        ("he isn't an idiot", {"negated insult": 1}),
        ("not that it matters much, idiot", {"bare insult": 1}),
        ("She said you are an idiot", {"reported insult": 1}),
        ('She said: "You are an idiot. Go." Fine.', {"reported insult": 1}),
        ('She said "You are an idiot. Moron." Idiot', {"reported insult": 2, "bare insult": 1}),
        ("She said “you are an idiot” and left", {"reported insult": 1}),
        ("I will kill you", {"directed threat": 1}),
        ("kill the process", {"bare threat": 1}),
        ("I will not kill you", {"negated threat": 1}),
        ("you idiot, I will kill you! Scum!", {"directed insult": 1, "directed threat": 1, "bare insult": 1}),
        ("idiot idiot moron", {"bare insult": 3}),
        ("nothing here", {}),
        ("", {}),
    ],
)
def test_clauses(text, want):
    assert kinds(text) == want


def test_table_is_the_cascade():
    """The composed table writes what the parts write one after the other."""
    r = random.Random(7)
    table = transducers.grammar().table()
    parts = [transducers.negation(), transducers.reported(), transducers.binding("insult"), transducers.binding("threat")]
    for _ in range(400):
        symbols = [r.choice(SYMBOLS) for _ in range(r.randint(0, 30))] + ["end"]
        want = symbols
        for p in parts:
            want = p(want)
        state, got = 0, []
        for x in symbols:
            state, more = table[state][SYMBOLS.index(x)]
            got += more
        assert got == want == transducers.grammar()(symbols)
        count = lambda what: sum(x == what for x in symbols)
        for what in ("insult", "threat"):  # each is written once, as one of the kinds
            assert sum(x in KINDS and x.endswith(what) for x in got) == count(what)


def test_far_words_change_nothing():
    long = " ".join(["word"] * 30)
    for text in (f"you {long} idiot", f"not {long} idiot {long} you"):
        assert kinds(text) == {"bare insult": 1}
    assert toxicity._FAR >= max(transducers.NEGATION_SCOPE, transducers.TARGET_BEFORE, transducers.TARGET_AFTER) + 1


def test_regression_finds_weights_and_keeps_the_prior_without_rows():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (4000, len(KINDS))).astype(float)
    true = np.array([-2, 3, 0, 0, -1, 0, 2, 0, 0.5])
    y = (rng.random(4000) < 1 / (1 + np.exp(-(true[0] + x @ true[1:])))).astype(int)
    w = toxicity.regression(x, y, np.ones(4000))
    assert np.abs(w - true).max() < 0.5
    assert np.allclose(toxicity.regression(x[:1], y[:1], np.zeros(1)), toxicity.PRIOR)


SF01 = "/root/testdata/sf0.1"  # the smaller tables hold out a handful of toxic texts


def test_held_out(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = op13_toxicity(spark, SF01).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert {r["doc_id"] for r in rows if r["held_out"]} == {i for i in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    known = [r for r in rows if r["held_out"] and r["doc_id"] in toxic]
    caught = [toxic[r["doc_id"]] for r in known if r["predicted"]]
    assert len(caught) > 80 and sum(caught) >= 0.97 * len(caught)
    assert sum(caught) >= 0.9 * sum(toxic[r["doc_id"]] for r in known)


def test_learns_new_words_but_not_those_of_copies(spark):
    r = random.Random(1)
    bad = ["gribble", "fnord"]
    rows, labels = [], []
    for i in range(400):
        words = data.prose(i, 40).split()
        if i % 5 == 0:
            words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    for i in range(400, 440):  # copies of one toxic text with a word of its own
        rows.append((i, "copied passage with quixotic word " + data.prose(1, 30)))
        labels.append((i, 1))
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    learned = toxicity._learned(toxicity._sample(docs, table, F.lit(True), 13))
    assert all(any(w.startswith(m.rstrip('$')) for m in learned) for w in bad)
    assert not any(m.startswith(('quix', 'copied', 'passage')) for m in learned)
    model = toxicity.fit(docs, table, F.lit(True))
    got = {r["doc_id"]: r["predicted"] for r in toxicity.scored(docs, model).collect()}
    assert all(got[i] == (i % 5 == 0) for i in range(400))


def test_learns_the_beginning_that_forms_share(spark):
    r = random.Random(2)
    rows = []
    for i in range(300):
        words = data.prose(i, 40).split()
        for _ in range(3 * (i % 6 == 0)):
            words.insert(r.randrange(len(words)), "zorba" + r.choice(["n", "sti", "qe", "lu", "mm"]))
        rows.append((i, " ".join(words), int(i % 6 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert "zorba" in toxicity._learned(toxicity._sample(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), F.lit(True), 13))


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC", 50)
    monkeypatch.setattr(toxicity, "CLEAN", 80)
    docs = spark.createDataFrame([(i % 500, f"text {i % 3}") for i in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)], "doc_id long, toxic int")
    rows = toxicity._sample(docs, labels, F.lit(True), 13).collect()
    assert 20 < sum(r["toxic"] for r in rows) < 90 and 40 < sum(1 - r["toxic"] for r in rows) < 130
    assert abs(sum(r["share"] for r in rows if r["toxic"]) - 250) < 100


def test_odd_rows_and_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(0, 1, 0), (0, 1, 1), (None, 1, 1), (6, None, None), (9, 1, 0), (777, 0, 1)], "doc_id long, quality int, toxic int")
    for name, docs, labels, n in (("a", data.odd(spark), some, len(data.rows())), ("b", data.odd(spark), none, len(data.rows())), ("c", data.empty(spark), some, 0)):
        where = data.write(spark, tmp_path / name, docs)
        labels.write.parquet(f"{where}/labels.parquet")
        rows = op13_toxicity(spark, where).collect()
        assert len(rows) == n and all(r["predicted"] == 0 and 0 <= r["score"] <= 1 for r in rows)
    kept = toxicity.scored(data.odd(spark), PLAIN)
    assert {"size", "label", "rank"} <= set(kept.columns) and kept.columns.count("score") == 1
