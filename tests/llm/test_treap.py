import math
import random
import re
from collections import Counter

import numpy as np

from signals.llm import treap
from signals.llm.q_lexical import op11_lexical
from tests.llm import data

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    """(item number, rank, doc_id, score) by scoring every document."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    df = Counter(t for _, c, _ in held for t in c)
    total = sum(n for _, _, n in held)
    out = []
    for number, text in items:
        scores = []
        for i, c, n in held:
            m = 50 + (50 * n * len(held)) // total
            w = {t: math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) for t in set(terms(text)) if t in c}
            score = sum(w[t] * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in w)
            if score > 0:
                scores.append((-score, i is not None, i or 0))
        for rank, (score, known, i) in enumerate(sorted(scores)[:k], 1):
            out.append((number, rank, i if known else None, -score))
    return sorted(out, key=lambda r: r[:2])


def test_terms_are_the_pattern():
    r = random.Random(3)
    for _ in range(300):
        text = "".join(r.choice("aZz09 _-.\n\x00\x7f\x1céÉß日😀[{@") for _ in range(r.randint(0, 40)))
        assert [t.decode() for t in treap.terms_of(text.encode())] == terms(text)


def test_quadtree_keeps_places_and_maxima():
    rng = np.random.default_rng(5)
    for size, n in ((1, 1), (2, 3), (40, 200), (300, 1000)):
        at = np.unique(rng.integers(0, size * size, n))
        row, column, value = at // size, at % size, rng.integers(1, 1000, len(at))
        height, masks, maxima, alone = treap.quadtree(row, column, value)
        t = treap.Treap(height, masks.tobytes(), maxima.tobytes(), alone.tobytes())
        assert t.most[0] == value.max()
        rows = np.arange(size)
        cells, columns = t.start(rows), np.zeros(1, np.int64)
        for level in range(height):
            above = t.most[cells]
            cells, columns = t.halves(cells, rows, level), np.concatenate([2 * columns, 2 * columns + 1])
            assert (t.most[cells] <= np.concatenate([above, above])).all()
        got = {(r, c): int(v) for c, line in zip(columns, t.most[cells]) for r, v in zip(rows, line) if v}
        assert got == {(int(r), int(c)): int(v) for r, c, v in zip(row, column, value)}


def test_equals_scoring_all(spark):
    docs = [(r[0], r[1]) for r in data.rows()]
    docs += [(100 + i, data.prose(i % 7, 20 + i % 40)) for i in range(120)]  # ties among ids
    items = [(1, data.prose(1, 30)), (1, "the WORD two"), (2, None), (3, ""), (4, "-- ! "), (None, "é日 日本 ẞ word"), (5, "nowhere-at-all"), (6, data.prose(9, 3000))]
    rows = [(*r, "x", "y") for r in items]
    table = spark.createDataFrame(rows, "item_id long, text string, rank string, score string")
    table = table.coalesce(1)
    rest = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, terms string").repartition(3)
    for size in (1, 3000, 1 << 20):
        found = treap.index(rest, block_bytes=size)
        got = treap.search(found, table, 7).collect()
        want = brute(docs, list(enumerate(items_text for _, items_text in items)), 7)
        key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0)
        assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=key) == sorted(((items[n][0], *rest) for n, *rest in want), key=key)


def test_more_passes_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, data.prose(i, 30)) for i in range(60)], "doc_id long, text string")
    items = spark.createDataFrame([(i, data.prose(i, 8)) for i in range(20)], "item_id long, text string")
    found = treap.index(docs, block_bytes=2000)
    one = sorted(map(tuple, treap.search(found, items, 5).collect()))
    monkeypatch.setattr(treap, "ITEM_BYTES", 100)
    assert sorted(map(tuple, treap.search(found, items, 5).collect())) == one and one


def test_bounds_spare_most_ranges():
    """A few documents that hold the rare terms are found without looking at most of the others."""
    docs = [f"the of and {data.prose(i, 40)}" for i in range(2000)]
    docs[77] += " zebra quagga okapi"
    ids, tokens, lengths = list(range(len(docs))), [t for d in docs for t in treap.terms_of(d.encode())], [len(treap.terms_of(d.encode())) for d in docs]
    ids, n, words, dfs, places, n_docs, n_terms = treap._block(ids, tokens, lengths)
    row, column, tf = np.frombuffer(places, np.int32).reshape(3, -1).astype(np.int64)
    height, masks, maxima, alone = treap.quadtree(row, column, 10**9 * tf // (1000 * tf + 2000))
    t, best = treap.Treap(height, masks.tobytes(), maxima.tobytes(), alone.tobytes()), treap.Best(1)
    rows = np.array([words.index(w) for w in (b"zebra", b"quagga", b"okapi")])
    seen = treap.descend(t, rows, np.array([5000, 5000, 5000]), np.array(ids), np.ones(len(ids), bool), best)
    assert best.id.tolist() == [77] and seen < 100


def test_empty_tables(spark, tmp_path):
    where = data.write(spark, tmp_path, data.empty(spark))
    spark.createDataFrame([(1, "word")], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    assert op11_lexical(spark, where).collect() == []
    full = spark.createDataFrame([(1, "word")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert treap.search(treap.index(full), none, 5).collect() == []
