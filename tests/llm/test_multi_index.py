import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from signals.llm import multi_index as mi
from signals.llm.q_negatives import op12_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, key string, score string, t string"


def vectors(seed, n, width=6, copies=0):
    r = random.Random(seed)
    out = [(i, [r.uniform(-1, 1) for _ in range(width)], r.randint(0, 3)) for i in range(n)]
    out += [(n + i, out[3][1], i % 2) for i in range(copies)]
    return out


def odd():
    nan, inf = float("nan"), float("inf")
    out = vectors(1, 350, copies=60)
    out += [(None, [0.3] * 6, 1), (1000, None, 1), (1001, [0.1, None, 0.2, 0.0, 0.0, 0.0], 1), (1100, [nan] * 6, 2), (1200, [inf] + [0.0] * 5, 2), (1300, [0.5] * 6, None)]
    out += [(1400, [], 1), (1500, [0.9, 0.8], 2), (1600, [0.0] * 6, 0), (None, None, None)]
    return out


def brute(rows, is_anchor, n_pos=5, n_neg=10):
    """Expected (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) by all products."""
    rows = [(i, np.floor(256 * np.float32(v).astype(float)).astype(object), lab) for i, v, lab in rows if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v, _ in rows), default=0)
    rows = [(i, [int(x) for x in v] + [0] * (width - len(v)), (lab + 1) % 10 if i is not None and i % 7 == 0 else lab) for i, v, lab in rows]
    out = []
    for k, (a, q, lab) in enumerate(rows):
        if a is None or not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i is not None, i or 0, other == lab) for n, (i, v, other) in enumerate(rows) if n != k)
        name = lambda known, i: i if known else None
        for p, known, i, _ in [s for s in scored if s[3]][:n_pos]:
            low, high = 30 * -p, 90 * -p
            for rank, (s, known2, j, _) in enumerate([s for s in scored if not s[3] and low <= 100 * -s[0] <= high][:n_neg], 1):
                out.append((a, name(known, i), rank, name(known2, j), -p, -s))
    return out


def found(spark, rows, **kw):
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    moved = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return [tuple(r) for r in mi.hard_negatives(mi.cleaned(table, moved), F.col("vec_id") % 100 == 0, **kw).collect()]


def same(got, want):
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    return sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("small", [False, True])
def test_equals_all_products(spark, monkeypatch, small):
    if small:
        for name, value in (("CELL_ROWS", 4), ("PIECE", 3), ("GROUP", 40), ("BATCH", 5)):
            monkeypatch.setattr(mi, name, value)
    rows = odd()
    got = found(spark, rows)
    assert len(got) > 100 and same(got, brute(rows, lambda i: i % 100 == 0))


def test_more_passes(spark, monkeypatch):
    rows = vectors(2, 420)
    monkeypatch.setattr(mi, "ANCHORS", 2)
    assert same(found(spark, rows), brute(rows, lambda i: i % 100 == 0))


def test_very_large_components(spark):
    rows = [(i, [v * 1e6 for v in x], lab) for i, x, lab in vectors(3, 120)]
    assert same(found(spark, rows), brute(rows, lambda i: i % 100 == 0))
    assert all(len(r) == 6 for r in found(spark, [(0, [3e38, 1.0], 1), (1, [3e38, 2.0], 1), (2, [1.0, 1.0], 2)]))


def test_repeated_anchor_rows(spark):
    rows = vectors(4, 150)
    rows += [rows[100], rows[0]]
    got, want = found(spark, rows), brute(rows, lambda i: i % 100 == 0)
    assert len(got) == len(want) and same([r[3:] for r in got], [r[3:] for r in want])


def test_walk_gives_falling_bounds_and_certified_stops():
    rng = np.random.default_rng(1)
    x = rng.integers(-100, 100, (400, 8))
    x[200:] += 300
    books = mi.codebook(x[:, :4].astype(float), 5), mi.codebook(x[:, 4:].astype(float), 5)
    i, j = (mi.nearest(p, b) for p, b in zip((x[:, :4], x[:, 4:]), books))
    pieces = []
    for a, b in {*zip(i.tolist(), j.tolist())}:
        own = np.flatnonzero((i == a) & (j == b))
        far = [float(np.sqrt(((p[own] - w) ** 2).sum(1)).max()) for p, w in ((x[:, :4], books[0][a]), (x[:, 4:], books[1][b]))]
        pieces.append({"i": a, "j": b, "keys": own.tolist(), "vec_ids": own.tolist(), "labels": [0] * len(own), "vectors": x[own].tobytes(), "radius1": far[0], "radius2": far[1]})
    group = mi.Group(pieces, books, 8, True)
    q = np.full((1, 8), 50)
    bounds = group.bounds(q)
    monkey, mi.BATCH = mi.BATCH, 1
    try:
        batches = [b for b in group.walk(bounds, 0, lambda: -(1 << 62), float("inf"))]
        assert sorted(np.concatenate(batches).tolist()) == list(range(400))
        best = np.sort(x @ q[0])[::-1]
        seen = np.concatenate([b for b in group.walk(bounds, 0, lambda: best[4], float("inf"))])
        assert len(seen) < 300 and set(best[:5]) <= set(group.scores(seen, q[0]).tolist())
        low = [b for b in group.walk(bounds, 0, lambda: -(1 << 62), 0.0)]
        assert sum(map(len, low)) < 400  # cells wholly above the windows are passed over
        assert set((x @ q[0])[(x @ q[0]) <= 0].tolist()) <= set(group.scores(np.concatenate(low), q[0]).tolist())
    finally:
        mi.BATCH = monkey


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op12_negatives(spark, str(tmp_path)).collect() == []
