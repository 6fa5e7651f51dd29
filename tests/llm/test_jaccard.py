import random
import re

import numpy as np
import pytest

from signals.llm import jaccard
from signals.llm.components import components
from signals.llm.q_jaccard import op9_jaccard
from tests.conftest import SF0001
from tests.llm import data

WORD = re.compile("[^\x20\x09-\x0d]+")


def sets_of(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    """(n_shingles, component) by comparing all pairs."""
    s = [sets_of(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(s)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least.setdefault(find(i), []).append(d)
    return [(len(s[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i in range(len(docs))]


def compare(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in jaccard.link_classes(df.repartition(5), **options).collect())
    assert got == sorted((str(d), n, str(c)) for (d, _), (n, c) in zip(docs, brute(docs)))


def noisy(n_groups, copies, size, seed, edits):
    """Groups of texts with a few words changed, from none to more than the threshold allows."""
    r, out = random.Random(seed), []
    for g in range(n_groups):
        base = [f"w{r.randrange(5000)}" for _ in range(size)]
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
            out.append((len(out), " ".join(w[r.randint(0, 2) :])))
    r.shuffle(out)
    return [(i, t) for i, (_, t) in enumerate(out)]


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op9_jaccard(spark, SF0001).collect()}
    assert got == {d: x for (d, _), x in zip(docs, brute(docs))}


@pytest.mark.parametrize("size,edits", [(9, 1), (14, 2), (30, 2), (120, 8)])
def test_near_copies_of_all_sizes(spark, size, edits):
    compare(spark, noisy(12, 10, size, size, edits))


@pytest.mark.parametrize("small", [0, 12, 64])
def test_any_boundary_gives_the_same_links(spark, small, monkeypatch):
    monkeypatch.setattr(jaccard, "boundary", lambda *_: small)
    compare(spark, noisy(8, 8, 13, 1, 2) + [(1000 + i, t) for i, t in noisy(4, 8, 60, 2, 4)])


def test_frequent_passages_and_cut_lists(spark, monkeypatch):
    """A passage in every document; lists of frequent shingles in parts of a few sets."""
    monkeypatch.setattr(jaccard, "PART", 3)
    monkeypatch.setattr(jaccard, "LONG", 4)
    monkeypatch.setattr(jaccard, "levels", lambda cells: (np.where(cells > 8, 3, 0), np.where(cells > 8, 4, 1), 1.0))
    passage = " ".join(f"p{i}" for i in range(40))
    compare(spark, [(i, f"{t} {passage}") for i, t in noisy(10, 6, 14, 3, 3)])


@pytest.mark.parametrize("turns,array", [(0, 4096), (1, 3)])
def test_near_copies_at_the_threshold_in_long_lists(spark, monkeypatch, turns, array):
    """Groups around the threshold whose lists are all long: pairs of single sets, of roots with several, and arrays not kept."""
    monkeypatch.setattr(jaccard, "LONG", 3)
    monkeypatch.setattr(jaccard, "TURNS", turns)
    monkeypatch.setattr(jaccard, "ARRAY", array)
    monkeypatch.setattr(jaccard, "CHUNK", 2)
    compare(spark, noisy(2, 40, 60, 5, 4) + [(1000 + i, t) for i, t in noisy(2, 20, 12, 6, 2)])


def test_a_group_at_the_threshold_is_not_tested_pair_by_pair(spark, monkeypatch):
    """Most pairs of the group come near the threshold; what is written for the exact test grows with its sets, not with their pairs."""
    tested, check = [], jaccard.check
    monkeypatch.setattr(jaccard, "check", lambda pairs, *rest: tested.append(pairs.count()) or check(pairs, *rest))
    docs = noisy(1, 240, 150, 11, 9)
    compare(spark, docs)
    assert 0 < sum(tested) < 6 * len(docs)


@pytest.mark.parametrize("columns,listed,sparse", [(1024, 1 << 20, 64), (3, 7, 2), (3, 7, 1)])
def test_blocks_find_links_that_join_what_links_join(monkeypatch, columns, listed, sparse):
    for name, value in (("COLUMNS", columns), ("LISTED", listed), ("SPARSE", sparse)):
        monkeypatch.setattr(jaccard, name, value)
    r = np.random.default_rng(5)
    sets = [np.unique(np.concatenate([r.choice(40, 37, False), 1000 + r.choice(5000, 3)])).astype(np.uint64) for _ in range(40)] + [np.arange(90000, 90003, dtype=np.uint64)]
    roots = np.array([i if i % 3 else 0 for i in range(len(sets))])
    for side in (np.zeros(len(sets), int), np.arange(len(sets)) % 2):
        links = {(i, j) for i in range(len(sets)) for j in range(len(sets)) if i != j and (side[i] < side[j] or not side.any()) and jaccard.linked(sets[i], sets[j])}
        found = jaccard.block_links(sets, side, roots)
        assert 0 < len(found) < len(set(roots)) and set(found) <= links

        def classes(pairs):
            label = roots.copy()
            for i, j in pairs:
                label[label == label[i]] = label[j]
            return {frozenset(np.flatnonzero(label == x).tolist()) for x in label}

        assert classes(found) == classes(links)


def test_odd_rows_and_empty_table(spark, tmp_path):
    docs = [(r[0], r[1]) for r in data.rows()]
    compare(spark, docs)
    assert op9_jaccard(spark, data.write(spark, tmp_path / "empty", data.empty(spark))).count() == 0
    folder = data.write(spark, tmp_path / "odd", data.odd(spark))
    assert op9_jaccard(spark, folder).count() == len(docs)


def test_one_of_each(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, "x y"), (4, ""), (4, ""), (None, None)], "doc_id long, text string")
    kept = sorted((str(r["doc_id"]), r["text"]) for r in jaccard.one_of_each(docs).collect())
    assert kept == sorted([("1", "a b c d e f"), ("3", "x y"), ("4", ""), ("4", ""), ("None", None)], key=lambda x: (x[0], str(x[1])))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(50)] + [(7, 7), (3000, 2000), (2500, 3000)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and all(got[1000 + i] == 1000 for i in range(1, 50)) and got[3000] == got[2500] == 2000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_boundary_and_bounds():
    assert [jaccard.overlap(n) for n in (1, 2, 3, 4, 8, 9)] == [1, 2, 3, 3, 6, 7]
    assert jaccard.boundary({}, 1.0) == 0
    assert jaccard.boundary({10: 1000}, 3.0) >= 10 > jaccard.boundary({10: 1000}, 1.0)
