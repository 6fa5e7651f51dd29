"""Hard-negative mining with an inverted multi-index.

A vector's integer components are cut into two halves. Each half has a codebook
(k-means on a bounded sample); the nearest codewords (i, j) name the row's
cell. Rows are range-partitioned and sorted by cell, so that a cell is stored
in pieces of at most ``PIECE`` rows with the largest distance of their halves
to the codewords.

A search holds a group of pieces at a time. For an anchor ``q`` the half score
of any row under codeword ``c`` is at most ``q.c + |q| * radius``; the codewords
of either half are sorted by that bound, and a heap (multi-sequence) gives the
cells in the order of the summed bounds. It stops when the next sum can't
change the result: below the fifth positive, or below every window's lower end
and tenth negative (a certified window). Cells whose lower bound lies above all
windows are passed over. Results are exact; codebooks decide only the speed.

First the positives of a block of at most ``ANCHORS`` anchors are found over the
whole index, then the negatives in the windows that the positives' scores set.
The driver holds the sample, the codebooks and one block of anchors with their
positives. Tasks carry each anchor's best rows from group to group and return
those only.

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part; a null id is no anchor, and sorts before others; a
vector shorter than the longest counts as filled up with zeros (an empty one
as all zeros); components and scores beyond 64 bits are cut to its ends;
repeated rows take part each for itself, and an anchor row is never its own
positive but may have its copies; an anchor without positives or without rows
in a window gets no rows; an empty table gives an empty result; only the named
columns are read, so others may have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signals.llm.common import forget, stored

SAMPLE = 20_000  # rows that the codebooks are fitted on
CELL_ROWS = 256  # rows that a cell is meant to hold
MOST_CODES = 256
PIECE = 4096
GROUP = 1 << 16  # rows that a search task holds at a time
ANCHORS = 1 << 15  # of a pass over the index
BATCH = 1024  # rows scored at a time
_SMALLEST, _LARGEST = -(1 << 63), (1 << 63) - 1

_PIECE = "i int, j int, keys array<bigint>, vec_ids array<bigint>, labels array<int>, vectors binary, radius1 double, radius2 double"


def cleaned(vectors: DataFrame, label: Column, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, vec_id, label, x) of the rows that take part: x = floor(256 * component), key tells rows apart."""
    usable = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.where(label.isNotNull() & F.col(vector).isNotNull() & usable).select(
        F.monotonically_increasing_id().alias("key"),
        F.col(vec_id).cast("long").alias("vec_id"),
        label.cast("int").alias("label"),
        F.transform(vector, lambda v: F.floor(v.cast("double") * 256).cast("long")).alias("x"),
    )


def matrix(x: pa.ListArray, width: int) -> np.ndarray:
    """The lists as rows of ``width`` integers, short ones filled up with zeros."""
    ends = np.asarray(x.offsets)
    values, sizes = x.values.to_numpy(zero_copy_only=False), np.diff(ends)
    out = np.zeros((len(x), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values[ends[0] : ends[-1]]
    return out


def codebook(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means of the rows from evenly spread rows in sorted order; at most ``k`` codewords, at least one."""
    rows = np.unique(sample, axis=0) if sample.size else np.zeros((1, sample.shape[1]))
    words = rows[np.unique(np.linspace(0, len(rows) - 1, min(k, len(rows))).astype(int))].astype(float)
    for _ in range(rounds if sample.size else 0):
        near = nearest(sample, words)
        sums = np.zeros_like(words)
        np.add.at(sums, near, sample)
        count = np.bincount(near, minlength=len(words))
        words[count > 0] = sums[count > 0] / count[count > 0, None]
    return words


def nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((words**2).sum(1) - 2.0 * (x.astype(float) @ words.T)).argmin(1)


class Index:
    """The stored pieces, the codebooks, and the arithmetic that scores need."""

    def __init__(self, pieces: DataFrame, rows: DataFrame, books: tuple[np.ndarray, np.ndarray], width: int, exact: bool):
        self.pieces, self.rows, self.books, self.width, self.exact = pieces, rows, books, width, exact


def index(rows: DataFrame) -> Index:
    """Index every row of :func:`cleaned`."""
    rows = stored(rows, "vectors")
    spark = rows.sparkSession
    size = F.aggregate("x", F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v.cast("double"))))
    total = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"), F.max(size).alias("most")).first()
    n, width, most = total["n"], total["width"] or 0, total["most"] or 0.0
    half = width // 2
    draw = F.pmod(F.xxhash64(F.lit(12), "vec_id", "x"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(n, 1)))
    drawn = rows.where(draw).select("x").limit(SAMPLE).toArrow()["x"].combine_chunks() if n else pa.array([], pa.list_(pa.int64()))
    sample = matrix(drawn, width).astype(float)
    codes = int(min(MOST_CODES, max(1.0, (n / CELL_ROWS) ** 0.5)))
    books = codebook(sample[:, :half], codes), codebook(sample[:, half:], codes)
    shared = spark.sparkContext.broadcast(books)

    def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = shared.value
        for batch in batches:
            x = matrix(batch.column(3), width)
            pair = [pa.array(nearest(part, book).astype(np.int32)) for part, book in ((x[:, :half], first), (x[:, half:], second))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *pair], names=["key", "vec_id", "label", "x", "i", "j"])

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = shared.value
        for batch in batches:
            x, i, j = matrix(batch.column(3), width), *(batch.column(c).to_numpy() for c in (4, 5))
            ends = [*(np.flatnonzero((i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1), len(x)] if len(x) else []
            start = 0
            for end in ends:
                for a in range(start, end, PIECE):
                    b, c = min(a + PIECE, end), a
                    part = x[a:b].astype(float)
                    radius = [float(np.sqrt(((p - w) ** 2).sum(1)).max()) for p, w in ((part[:, :half], first[i[c]]), (part[:, half:], second[j[c]]))]
                    lists = [pa.array([batch.column(k).slice(a, b - a).to_pylist()], pa.list_(t)) for k, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.int32()))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i[c]], pa.int32()), pa.array([j[c]], pa.int32()), *lists, pa.array([x[a:b].tobytes()], pa.binary()), *(pa.array([r]) for r in radius)],
                        names=["i", "j", "keys", "vec_ids", "labels", "vectors", "radius1", "radius2"],
                    )
                start = end

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["i", "j", "vec_id", "key"]
    placed = rows.mapInArrow(cells, "key bigint, vec_id bigint, label int, x array<bigint>, i int, j int")
    pieces = stored(placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(packed, _PIECE), "multi-index")
    return Index(pieces, rows, books, width, width * max(most, 1.0) ** 2 < 2**52)


class Group:
    """Some pieces as one matrix, with the codewords that occur, their radii, and the rows of each cell."""

    def __init__(self, pieces: list[dict], books, width: int, exact: bool):
        pieces.sort(key=lambda p: (p["i"], p["j"]))
        flat = lambda k: [v for p in pieces for v in p[k]]
        x = np.concatenate([np.frombuffer(p["vectors"], np.int64).reshape(len(p["keys"]), width) for p in pieces])
        self.x = x.astype(float) if exact else x.astype(object)
        self.exact = exact
        ids = pa.array(flat("vec_ids"), pa.int64())
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids, self.keys, self.labels = ids.fill_null(0).to_numpy(), np.array(flat("keys"), np.int64), np.array(flat("labels"), np.int64)
        half = width // 2
        self.books, self.halves = [], (slice(0, half), slice(half, width))
        place = []
        for name, radius, book in (("i", "radius1", books[0]), ("j", "radius2", books[1])):
            used = sorted({p[name] for p in pieces})
            at = {code: k for k, code in enumerate(used)}
            most = np.zeros(len(used))
            for p in pieces:
                most[at[p[name]]] = max(most[at[p[name]]], p[radius])
            self.books.append((book[used], most))
            place.append([at[p[name]] for p in pieces])
        self.cells: dict[tuple[int, int], tuple[int, int]] = {}
        start = 0
        for i, j, p in zip(*place, pieces):
            a, _ = self.cells.get((i, j), (start, start))
            start += len(p["keys"])
            self.cells[i, j] = a, start

    def bounds(self, anchors: np.ndarray):
        """For each half: upper and lower bounds of the anchors' half scores by codeword, and the order of the upper ones."""
        out = []
        for part, (words, radius) in zip(self.halves, self.books):
            q = anchors[:, part].astype(float)
            score = q @ words.T
            # room for rounding, so that a bound is never too tight
            reach = np.sqrt((q**2).sum(1))[:, None] * radius[None, :] * (1 + 1e-9) + 1e-9 * np.abs(score) + 1e-6
            out.append((score + reach, score - reach, np.argsort(-(score + reach), axis=1, kind="stable")))
        return out

    def walk(self, bounds, k: int, floor, ceiling: float):
        """Row numbers of anchor ``k``'s cells in batches, best bound first, until a bound is below ``floor()``."""
        (high1, low1, order1), (high2, low2, order2) = ((h[k], lo[k], o[k].tolist()) for h, lo, o in bounds)
        sum_of = lambda a, b: -float(high1[order1[a]] + high2[order2[b]])
        heap, rows, n = [(sum_of(0, 0), 0, 0)], [], 0
        while heap:
            bound, a, b = heapq.heappop(heap)
            if -bound < floor():
                break
            if b + 1 < len(order2):
                heapq.heappush(heap, (sum_of(a, b + 1), a, b + 1))
            if b == 0 and a + 1 < len(order1):
                heapq.heappush(heap, (sum_of(a + 1, 0), a + 1, 0))
            i, j = order1[a], order2[b]
            cell = self.cells.get((i, j))
            if cell is None or low1[i] + low2[j] > ceiling:
                continue
            rows.append(np.arange(*cell))
            n += len(rows[-1])
            if n >= BATCH:
                yield np.concatenate(rows)
                rows, n = [], 0
        if rows:
            yield np.concatenate(rows)

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.exact:
            return (self.x[rows] @ q.astype(float)).astype(np.int64)
        return np.array([min(max(int(s), _SMALLEST), _LARGEST) for s in self.x[rows] @ q.astype(object)], np.int64)


class Top:
    """The k best rows so far: higher scores, then smaller ids (null first), then keys; scores from ``least`` on."""

    def __init__(self, k: int, least: int = _SMALLEST):
        self.k, self.floor = k, least
        self.rows = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, bool), np.zeros(0, np.int64)]

    def add(self, score, ids, known, keys) -> None:
        rows = [np.concatenate(pair) for pair in zip(self.rows, (score, ids, known, keys))]
        score, ids, known, keys = rows
        best = np.lexsort((keys, ids, known, ~score))[: self.k]  # ~s falls as s grows, at the ends of 64 bits too
        self.rows = [r[best] for r in rows]
        if len(best) == self.k:
            self.floor = max(self.floor, int(self.rows[0][-1]))


def _searched(index: Index, anchors: list, make, visit, schema: str) -> DataFrame:
    """For each task and anchor the rows of ``make(anchor)``'s tops, filled by ``visit(group, bounds, k, anchor, tops)``."""
    shared = index.pieces.sparkSession.sparkContext.broadcast((anchors, index.books))
    width, exact = index.width, index.exact

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, books = shared.value
        tops = [make(a) for a in anchors]
        vectors = np.array([a["x"] for a in anchors], np.int64).reshape(len(anchors), width)

        def search(pieces: list[dict]) -> None:
            group = Group(pieces, books, width, exact)
            for at in range(0, len(anchors), 1024):
                bounds = group.bounds(vectors[at : at + 1024])
                for k, a in enumerate(anchors[at : at + 1024]):
                    visit(group, bounds, k, a, vectors[at + k], tops[at + k])

        pieces, n = [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                piece = batch.slice(at, 1).to_pylist()[0]
                if n and n + len(piece["keys"]) > GROUP:
                    search(pieces)
                    pieces, n = [], 0
                pieces.append(piece)
                n += len(piece["keys"])
        if pieces:
            search(pieces)
        out = [(a["key"], t, top.rows) for a, own in zip(anchors, tops) for t, top in enumerate(own) if len(top.rows[0])]
        if out:
            sizes = [len(rows[0]) for _, _, rows in out]
            score, ids, known, keys = (np.concatenate([rows[c] for _, _, rows in out]) for c in range(4))
            of = [pa.array(np.repeat(np.array([x[c] for x in out], np.int64), sizes)) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*of, pa.array(score), pa.array(ids, mask=~known), pa.array(keys)], names=["anchor", "t", "score", "vec_id", "key"])

    return index.pieces.mapInArrow(run, schema)


_FOUND = "anchor bigint, t bigint, score bigint, vec_id bigint, key bigint"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each (anchor, t) over all tasks, with their rank."""
    order = Window.partitionBy("anchor", "t").orderBy(F.desc("score"), F.asc_nulls_first("vec_id"), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _positives(index: Index, anchors: list, k: int) -> DataFrame:
    def visit(group, bounds, n, a, q, tops):
        top = tops[0]
        for rows in group.walk(bounds, n, lambda: top.floor, float("inf")):
            rows = rows[(group.labels[rows] == a["label"]) & (group.keys[rows] != a["key"])]
            score = group.scores(rows, q)
            good = score >= top.floor
            top.add(score[good], group.ids[rows][good], group.known[rows][good], group.keys[rows][good])

    return _ranked(_searched(index, anchors, lambda a: [Top(k)], visit, _FOUND), k)


def _negatives(index: Index, anchors: list, k: int, low: int, high: int) -> DataFrame:
    """``anchors`` with ``positive`` scores; windows from ``low`` to ``high`` percent of each."""

    def visit(group, bounds, n, a, q, tops):
        ends = [high * p // 100 for p in a["positive"]]
        floor = lambda: min(top.floor for top, end in zip(tops, ends) if top.floor <= end)
        if all(top.floor > end for top, end in zip(tops, ends)):
            return
        for rows in group.walk(bounds, n, floor, max(ends)):
            rows = rows[group.labels[rows] != a["label"]]
            score = group.scores(rows, q)
            for top, end in zip(tops, ends):
                good = (score >= top.floor) & (score <= end)
                if good.any():
                    top.add(score[good], group.ids[rows][good], group.known[rows][good], group.keys[rows][good])

    return _ranked(_searched(index, anchors, lambda a: [Top(k, -(-low * p // 100)) for p in a["positive"]], visit, _FOUND), k)


def hard_negatives(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows of :func:`cleaned`.

    Each anchor's ``n_positives`` best other rows of its label are its positives; for each of them the
    ``n_negatives`` best rows of other labels whose score is from ``low`` to ``high`` percent of the positive's.
    """
    found = index(rows)
    anchors = stored(found.rows.where(F.coalesce(is_anchor, F.lit(False))), "anchors")
    passes = 1 + anchors.count() // ANCHORS
    result = None
    for n in range(passes):
        block = [r.asDict() for r in anchors.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == n).orderBy("key").collect()]
        for a in block:
            a["x"] = [*a["x"], *[0] * (found.width - len(a["x"]))]
        positives = stored(_positives(found, block, n_positives), "positives")
        of_anchor: dict[int, list] = {}
        for r in positives.orderBy("anchor", "rank").collect():
            of_anchor.setdefault(r["anchor"], []).append(r["score"])
        block = [a | {"positive": of_anchor[a["key"]]} for a in block if a["key"] in of_anchor]
        pairs = positives.select("anchor", (F.col("rank") - 1).cast("long").alias("t"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        negatives = _negatives(found, block, n_negatives, low, high)
        own = negatives.join(pairs, ["anchor", "t"]).join(anchors.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        own = own.select("anchor_id", "positive_id", F.col("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        own = own if passes == 1 else stored(own, "negatives")
        result = own if result is None else result.union(own)
    if passes > 1:
        forget(found.pieces)
    return result
