import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from signals.llm import ppm
from signals.llm.common import crc_mod
from signals.llm.q_ppm import op4_ppm
from tests.conftest import SF0001
from tests.llm import data

WORD = re.compile("[^\x20\x09-\x0d]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def check(rows, docs, order):
    """Against a plain trie and a plain counter."""
    train = [t for i, t in docs if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    trie, words = ppm.AdaptiveTrie(order), Counter()
    for t in train:
        trie.read(t)
        words.update([*WORD.findall(low(t)), "<end>"])
    n, v = sum(words.values()), len(words)
    want = []
    for i, t in docs:
        tokens = [*WORD.findall(low(t)), "<end>"]
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        want.append((-1 if i is None else i, len(tokens), sum(words[w] > 0 for w in tokens), n, base, trie.read(t, learn=False)))
    got = [(-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows]
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:4] == b[:4]
        np.testing.assert_allclose(a[4:], b[4:], rtol=1e-6)


def test_query_against_plain_trie(spark, tmp_path):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", F.substring("text", 1, 1200).alias("text")).limit(60)
    folder = data.write(spark, tmp_path, docs)
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    check(op4_ppm(spark, folder).collect(), [(r["doc_id"], r["text"]) for r in rows], ppm.ORDER)


def test_odd_rows_and_empty_table(spark, tmp_path):
    docs = data.odd(spark).where("text is null or length(text) < 3000")
    rows = docs.collect()
    check(op4_ppm(spark, data.write(spark, tmp_path / "odd", docs)).collect(), [(r["doc_id"], r["text"]) for r in rows], ppm.ORDER)
    assert op4_ppm(spark, data.write(spark, tmp_path / "empty", data.empty(spark))).count() == 0


def test_blocks_and_rare_words_change_nothing(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    train = crc_mod(F.col("doc_id"), 10) != 0
    one = ppm.score(docs, train).toPandas().sort_values("doc_id")
    many = ppm.score(docs, train, nodes=5000, most=50).toPandas().sort_values("doc_id")
    for c in one.columns:
        np.testing.assert_allclose(one[c], many[c], rtol=1e-6)


def test_held_out_texts_are_likelier_than_shuffled_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", F.lit(False).alias("turned"))
    held = crc_mod(F.col("doc_id"), 10) == 0
    both = docs.union(docs.where(held).select("doc_id", F.reverse("text"), F.lit(True)))
    s = ppm.score(both, (crc_mod(F.col("doc_id"), 10) != 0) & ~F.col("turned")).where(held).groupBy("turned").agg(F.sum("score").alias("s"))
    by = {r["turned"]: r["s"] for r in s.collect()}
    assert by[False] > 0.8 * by[True]


def test_probabilities_sum_to_one():
    trie = ppm.AdaptiveTrie(3)
    for t in ("abracadabra", "alakazam", "banana"):
        trie.read(t)
    for context in (b"bra", b"aka", b"zzz", b"\0\0\0"):
        assert abs(sum(10 ** trie.log10p(context, s) for s in range(256)) - 1) < 1e-9


def test_adaptive(spark):
    docs = spark.createDataFrame([(1, "ab" * 100), (2, None), (3, "the quick brown fox")], "id long, text string")
    s = {r["id"]: r["score"] for r in ppm.adaptive(docs, order=3).collect()}
    assert s[2] == -math.log10(256) and s[1] > -40  # a repeated text costs little


def test_columns_called_as_inner_ones(spark):
    rows = [(i, f"some words {i} here", f"r{i}", f"t{i}", i) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rare string, times string, more long")
    got = {r["doc_id"]: (r["rare"], r["times"], r["more"]) for r in ppm.score(docs, F.col("more") != 3, most=3).collect()}
    assert got == {r[0]: r[2:] for r in rows}
