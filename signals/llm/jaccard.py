"""N-gram Jaccard join: all links of similarity 0.75 and more between shingle sets, by a size-aware heavy-light join.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. The
shingles have one global order, rare before frequent, from a table of counts
of fixed size. Two sets that link share at least ``ceil(0.75 n)`` of either's
n shingles, so the c least shingles that they share are among the first
``n - ceil(0.75 n) + c`` of both.

* Small sets list all pairs (c = 2) of these first shingles as join keys: more
  keys, but hardly any false candidate.
* Large sets list the first shingles themselves (c = 1) and scan the inverted
  lists; sets that can link with a large one are in these lists, too.
* The boundary between small and large is where the summed cost of keys and of
  the candidates they bring, by the sizes and counts at hand, is least.

What two sets share beyond their first shingles is bounded by their sizes and by
where their first shingles lie in the order (``MARKS`` keeps a few of these
places of each set), so ``need`` says how many first shingles a linking pair
has in common at least: a tenth of a set's size and more. Short lists are joined and
shared ones counted. Lists of more than ``LONG`` sets, of passages that many
texts quote, are known to their sets: each has the array of its long lists, and
what a pair has in common there adds to its short lists. (Arrays of more than
``ARRAY`` lists are not kept; then the most that they can add counts.)

Only the classes of links are wanted, so long lists are not expanded into all
of their pairs: each set is first checked against one of the list (if the pair
may need it, as above), in ``TURNS`` rounds with different heads, and sets that link
get one root. Lists of very frequent shingles are cut into parts for these rounds,
the parts' heads are checked against each other, and the whole lists take part in
what follows:

* A set is dense if its long lists alone reach the need of a pair of its size.
  Dense sets are many in few groups, and most pairs of a group come near the
  threshold, so they are compared whole: long lists are gathered into bundles, by
  the member with most long lists, and a bundle's sets of different roots are
  compared in blocks, all pairs of a block by one matrix product over all shingles
  (:func:`block_links`). Only links that join roots are written, no pairs.
* Pairs in long lists with a set that is not dense are few that may need them; they
  are counted as those in short lists.

No link between different roots is lost.

Equal sets are one set throughout. Texts are fetched, packed, for the sets to
check only (a filter of fixed size lets few others through), and the
similarity is computed exactly from both sets.

Defined results: a null text is empty; with fewer than five words the whole
sequence is the one shingle; a document without words has no set and links
with nothing, its component is itself; repeated rows are equal sets; null ids
take part and are never the least id.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signals.llm.common import add_columns, forget, stored
from signals.llm.components import components
from signals.llm.hashing import Powers, mixed, shingles, word_hashes

K = 5
PERCENT = 75
#: Shingles are counted in this many cells; cells far above the mean hold frequent ones.
CELLS = 1 << 16
#: What a pair in a list costs that is joined, counted and maybe checked, in units of a join key.
PAIR_COST = 4.0
#: Sets up to this size may be small.
MOST_SMALL = 64
#: Members of a frequent shingle's list that make a part.
PART = 2000
#: Longer lists are linked by heads first.
LONG = 32
#: Long lists of a set that are kept as an array.
ARRAY = 4096
#: Sets, and shingles, on a side of a block; larger bundles are cut into blocks.
CHUNK = 1000
BLOCK = 1 << 19
#: A shingle is a column of the matrices if so many times its pairs are at least the block's; others' pairs are listed, so many at a time.
SPARSE = 64
LISTED = 1 << 20
#: Columns of the matrices at a time.
COLUMNS = 1024
#: Rounds with other heads.
TURNS = 2
#: Eighths of a set's first shingles whose places in the order are kept.
MARKS = (4, 6, 7, 8)
#: Bits of the filter for texts to fetch.
FILTER_BITS = 1 << 23


def overlap(n, percent: int = PERCENT):
    """How many of n shingles a set shares with any that it links with, at least."""
    return -(-n * percent // 100)


def shingle_set(text: str | None, powers: Powers, k: int = K) -> np.ndarray:
    return np.unique(shingles(word_hashes((text or "").encode("utf-8", "replace"), powers), k))


def _set_id(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    one, two = mixed(s), mixed(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return int(one.sum(dtype=np.uint64).view(np.int64)), int(two.sum(dtype=np.uint64).view(np.int64))


def linked(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common) > 0


def read_sets(docs: DataFrame, k: int) -> DataFrame:
    """A row per document (kind 0: doc_id, th, n, a, b) and the shingles' counts by cell (kind 1: n the cell, a the count).

    ``th`` hashes the text, a and b the set. A set that a task meets again is not counted again.
    """
    schema = f"kind int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, th long, n long, a long, b long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, cells, known, kind = Powers(), np.zeros(CELLS, np.int64), set(), pa.int64()
        names = ["kind", "doc_id", "th", "n", "a", "b"]
        for batch in batches:
            kind, rows = batch.column("doc_id").type, []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, powers, k)
                key = _set_id(s)
                if key not in known:
                    known.add(key)
                    cells += np.bincount((s >> np.uint64(48)).astype(np.int64), minlength=CELLS)
                rows.append((len(s), *key))
            values = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(rows), np.int32)), batch.column("doc_id"), batch.column("th"), *values], names=names)
        at = np.flatnonzero(cells)
        none = lambda t: pa.nulls(len(at), t)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(at), np.int32)), none(kind), none(pa.int64()), pa.array(at), pa.array(cells[at]), none(pa.int64())], names=names)

    return docs.mapInArrow(run, schema)


def levels(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """By cell: its place in the order (0: nothing frequent in it), parts for its lists; the mean list length of the others."""
    mean = max(float(cells.mean()), 1e-9)
    frequent = cells > mean + 6 * math.sqrt(mean) + 6
    level = np.where(frequent, 1 + np.floor(4 * np.log2(np.maximum(cells / mean, 1))), 0).astype(np.int64)
    parts = np.where(frequent, np.ceil((cells - mean) / PART), 1).astype(np.int64)
    rest = cells[~frequent].astype(float)
    # shingles that occur once make a cell's variance its mean; what is more comes from longer lists
    length = max(1.0, rest.var() / rest.mean()) if len(rest) and rest.mean() > 0 else 1.0
    return level, np.maximum(parts, 1), length


def boundary(sizes: dict[int, int], length: float, percent: int = PERCENT) -> int:
    """The largest small size: the sum of the costs of all sets' keys and candidates is least."""
    first = lambda n, c: n - overlap(n, percent) + c

    def cost(b: int) -> float:
        total = 0.0
        for n, count in sizes.items():
            if n <= b:
                total += count * math.comb(first(n, 2), 2)
            if 100 * (b + 1) <= 100 * n or 100 * n >= percent * (b + 1):
                total += count * first(n, 1) * (1 + PAIR_COST * (length - 1) / 2)
        return total

    return min(range(0, MOST_SMALL + 1), key=lambda b: (cost(b), b))


def mark_counts(first):
    """How many of ``first`` first shingles lie up to each mark."""
    return [(first * m + 7) // 8 for m in MARKS]


def keys_of(s: np.ndarray, level: np.ndarray, small: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A set's join keys, each one's cell (-1: a pair of shingles), and the set's marks."""
    n = len(s)
    cell = (s >> np.uint64(48)).astype(np.int64)
    place = (level[cell] << 48).astype(np.uint64) | (s >> np.uint64(16))
    order = np.argsort(place, kind="stable")  # s ascends: ties are in its order
    keys, cells, marks = [s[:0]], [cell[:0]], s[:0]
    if 2 <= n <= small:
        first = s[order[: n - overlap(n, percent) + 2]]
        i, j = np.triu_indices(len(first), 1)
        keys.append(mixed(mixed(np.minimum(first[i], first[j])) + np.maximum(first[i], first[j])))
        cells.append(np.full(len(i), -1))
    if n >= 2 and 100 * n >= percent * (small + 1):
        at = order[: n - overlap(n, percent) + 1]
        keys.append(s[at])
        cells.append(cell[at])
        marks = place[at[[c - 1 for c in mark_counts(len(at))]]]
    return np.concatenate(keys), np.concatenate(cells), marks


def postings(docs: DataFrame, level: np.ndarray, parts: np.ndarray, small: int, k: int, percent: int) -> DataFrame:
    """(key, part, id, n): the join keys of every distinct set, once per task; part -1: the list is not cut, -2: nor its key one shingle.

    Rows with part -3 are a set's marks: the key is the place in the order, n the number of the mark.
    """
    shared = docs.sparkSession.sparkContext.broadcast((level, parts))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, known, (level, parts) = Powers(), set(), shared.value
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                s = shingle_set(text, powers, k)
                a = _set_id(s)[0]
                if len(s) > 1 and a not in known:
                    known.add(a)
                    keys, cells, marks = keys_of(s, level, small, percent)
                    cuts = np.where(cells >= 0, parts[cells], 1)
                    part = np.where(cells < 0, -2, np.where(cuts > 1, (a & 0x7FFFFFFF) % cuts, -1))
                    part = np.concatenate([part, np.full(len(marks), -3)]).astype(np.int32)
                    n = np.concatenate([np.full(len(keys), len(s)), np.arange(len(marks))])
                    found.append((np.concatenate([keys, marks]).view(np.int64), part, np.full(len(n), a), n))
                if len(found) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["key", "part", "id", "n"])
                    found = []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["key", "part", "id", "n"])

    return docs.select("text").mapInArrow(run, "key long, part int, id long, n long")


def _class(turn: int):
    """Sets of one class are near enough in size to link; every other round's classes lie across."""
    return F.floor(F.log(F.col("n").cast("double")) / math.log(4 / 3) + 0.5 * (turn % 2))


def _compatible(x: str, y: str, percent: int):
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


_PLACES = [f"m{i}" for i in range(len(MARKS))]


def _overlap(n, percent: int):
    return F.ceil(percent * n / F.lit(100) - 1e-9)


def need(x, y, percent: int):
    """First shingles that two sets (structs with n and marks m0 to m3) have in common at least if they link.

    Common shingles up to the lesser of the two last first shingles are in both
    prefixes. Beyond it, the set whose last it is has ``overlap(n) - 1``
    shingles left, the other all but those that its marks show to lie before.
    """
    total = F.ceil(percent * (x["n"] + y["n"]) / F.lit(100 + percent) - 1e-9)
    last = len(MARKS) - 1

    def beyond(of, at):
        first = of["n"] - _overlap(of["n"], percent) + 1
        before = F.lit(0)
        for i, m in enumerate(MARKS):
            before = F.when(of[f"m{i}"] <= at, F.floor((first * m + 7) / 8)).otherwise(before)
        return of["n"] - before

    left = lambda a, b: F.least(_overlap(a["n"], percent) - 1, beyond(b, a[f"m{last}"]))
    rest = F.when(x[f"m{last}"] <= y[f"m{last}"], left(x, y)).otherwise(left(y, x))
    return F.greatest(F.lit(1), total - F.coalesce(rest, F.greatest(_overlap(x["n"], percent), _overlap(y["n"], percent)) - 1))


def need_twos(x, y, percent: int):
    """Pairs of first shingles that two small sets have in common at least: all pairs of the shingles that they need."""
    total = F.ceil(percent * (x["n"] + y["n"]) / F.lit(100 + percent) - 1e-9)
    both = F.greatest(F.lit(2), total - F.greatest(_overlap(x["n"], percent), _overlap(y["n"], percent)) + 2)
    return both * (both - 1) / 2


def _may(part, x, y, percent: int):
    """Can a pair in a long list need it, given in how many long lists either set is?"""
    twos = need_twos(x, y, percent) <= F.least(x["longs2"], y["longs2"])
    return F.when(part == -2, twos).otherwise(need(x, y, percent) <= F.least(x["longs"], y["longs"]))


def star_pairs(lists: DataFrame, turn: int, percent: int) -> DataFrame:
    """(a, b): in each long list's part and size class every set with the head; the parts' heads with the least head."""
    one = F.struct(F.xxhash64(F.lit(turn), "id").alias("draw"), "id", "n", "longs", "longs2", "root", *_PLACES)
    rows = lists.withColumn("class", _class(turn)).withColumn("head", F.min(one).over(Window.partitionBy("key", "part", "class")))
    pairs = rows.select(one.alias("x"), F.col("head").alias("y"), "part")
    heads = rows.where("part >= 0").select("key", "class", "head").distinct()
    tops = heads.groupBy("key", "class").agg(F.min("head").alias("top"))
    across = heads.join(tops, ["key", "class"]).select(F.col("head").alias("x"), F.col("top").alias("y"), F.lit(0).alias("part"))
    may = _may(F.col("part"), F.col("x"), F.col("y"), percent)
    both = pairs.union(across).where((F.col("x.root") != F.col("y.root")) & _compatible("x.n", "y.n", percent) & may)
    return both.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def with_roots(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """The lists' rows with the roots of their sets, where a list has more than one."""
    every = roots.union(roots.select("root", "root").distinct())
    rows = lists.join(every, "id", "left").withColumn("root", F.coalesce("root", "id"))
    many = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    return rows.join(many, "key", "left_semi")


def bundles(rows: DataFrame) -> DataFrame:
    """(bundle, id, root, n): the dense sets of all long lists with more than one root of them, by the lists' heads."""
    rows = rows.where("dense").withColumn("twos", F.col("part") == -2)
    head = F.min(F.struct(-F.greatest("longs", "longs2"), F.xxhash64("id"), "id"))["id"]
    lists = rows.groupBy("key", "twos").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), head.alias("bundle")).where("lo <> hi")
    return rows.join(lists.select("key", "twos", "bundle"), ["key", "twos"]).select("bundle", "id", "root", "n").distinct()


def blocks(members: DataFrame) -> DataFrame:
    """``members`` of bundles in their blocks (``one``, ``two``: the parts that a block compares, ``side``: the set's own).

    Sets of a root with half of a large bundle have parts of their own, which are not compared with each other.
    """
    parts = lambda sets, shingles: F.ceil(F.greatest(F.col(sets) / CHUNK, F.col(shingles) / BLOCK)).cast("long")
    by_root = members.groupBy("bundle", "root").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    sizes = by_root.groupBy("bundle").agg(F.sum("sets").alias("sets"), F.sum("shingles").alias("shingles"), F.max(F.struct("shingles", "sets", "root")).alias("most"))
    apart = (parts("sets", "shingles") > 1) & (2 * F.col("most.shingles") >= F.col("shingles"))
    sizes = sizes.select(
        "bundle",
        F.when(apart, F.col("most.root")).alias("major"),
        F.when(apart, parts("most.sets", "most.shingles")).otherwise(F.lit(0)).alias("own"),
        F.when(apart, F.col("sets") - F.col("most.sets")).otherwise(F.col("sets")).alias("sets"),
        F.when(apart, F.col("shingles") - F.col("most.shingles")).otherwise(F.col("shingles")).alias("shingles"),
    )
    rows = members.join(sizes.select("bundle", "major", "own", parts("sets", "shingles").alias("rest")), "bundle")
    major = F.coalesce(F.col("root") == F.col("major"), F.lit(False))
    draw = F.xxhash64("id")
    rows = rows.withColumn("side", F.when(major, F.col("rest") + F.pmod(draw, F.col("own"))).otherwise(F.pmod(draw, F.col("rest"))))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(major, F.col("rest")).otherwise(F.col("rest") + F.col("own")) - 1)))
    return rows.select("bundle", F.least("side", "other").alias("one"), F.greatest("side", "other").alias("two"), "side", "id", "root")


def common_counts(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many values each of the sets ``a`` (indexes) shares with each of ``b``."""
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    row_a, row_b = np.full(len(sets), -1), np.full(len(sets), -1)
    row_a[a], row_b[b] = np.arange(len(a)), np.arange(len(b))
    in_a, in_b = row_a[owner] >= 0, row_b[owner] >= 0
    n_a, n_b = (np.bincount(at[x], minlength=len(values)) for x in (in_a, in_b))
    often = (n_a * n_b * SPARSE >= len(a) * len(b)) & (n_a > 0) & (n_b > 0)
    counts, columns = np.zeros((len(a), len(b)), np.float32), np.flatnonzero(often)
    for lo in range(0, len(columns), COLUMNS):
        some = columns[lo : lo + COLUMNS]
        place = np.full(len(values), -1)
        place[some] = np.arange(len(some))
        hit = place[at] >= 0
        filled = np.zeros((len(sets), len(some)), np.float32)  # counts below 2^24 are exact
        filled[owner[hit], place[at[hit]]] = 1
        counts += filled[a] @ filled[b].T
    counts = counts.astype(np.int64)
    rare = (n_a > 0) & (n_b > 0) & ~often
    of_a, of_b = (np.flatnonzero(x & rare[at]) for x in (in_a, in_b))
    of_b = of_b[np.argsort(at[of_b], kind="stable")]
    begin, times = np.searchsorted(at[of_b], at[of_a]), n_b[at[of_a]]
    ends = np.cumsum(times)
    cuts = np.unique(np.searchsorted(ends, np.arange(LISTED, ends[-1], LISTED))) if len(ends) else []
    for some in np.split(np.arange(len(of_a)), cuts):
        t = times[some]
        within = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
        x, y = np.repeat(row_a[owner[of_a[some]]], t), row_b[owner[of_b[np.repeat(begin[some], t) + within]]]
        counts += np.bincount(x * len(b) + y, minlength=counts.size).reshape(counts.shape)
    return counts


def block_links(sets: list[np.ndarray], side: np.ndarray, roots: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links between the sets of the two sides (of one with itself), enough of them to join all roots that links join."""
    a, b = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
    n, label = np.array([len(s) for s in sets]), np.unique(roots, return_inverse=True)[1]
    common = common_counts(sets, a, b)
    link = (100 * common >= percent * (n[a][:, None] + n[b][None] - common)) & (label[a][:, None] != label[b][None])
    found = []
    for i in np.flatnonzero(link.any(axis=1)).tolist():
        x, to = a[i], b[np.flatnonzero(link[i])]
        for old, j in zip(*np.unique(label[to], return_index=True)):
            if old != label[x]:
                found.append((int(x), int(to[j])))
                label[label == old] = label[x]
    return found


def dense_links(members: DataFrame, packs: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): links that join the roots of all linked sets that have a bundle in common."""
    rows, powers = blocks(members).join(packs, "id"), Powers()

    def run(table: pa.Table) -> pa.Table:
        roots, found = table["root"].to_numpy(), []
        if roots.min() < roots.max():
            sets = [unpacked(p, powers, k) for p in table["pack"].to_pylist()]
            found = block_links(sets, table["side"].to_numpy(), roots, percent)
        ids, ends = table["id"].to_numpy(), np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": ids[ends.min(axis=1)], "b": ids[ends.max(axis=1)]} if found else {"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})

    return rows.groupBy("bundle", "one", "two").applyInArrow(run, "a long, b long").distinct()


def counted_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs with different roots, not both dense, whose long lists in common are enough."""
    twos = F.col("part") == -2
    own = {"twos": twos, "root": "root", "dense": "dense", "n": "n", "over": _overlap(F.col("n"), percent), "most": F.when(twos, F.col("longs2")).otherwise(F.col("longs")), "x": F.struct("id", "n", *_PLACES)}
    side = lambda i: rows.select("key", F.col("id").alias(f"id{i}"), *[(F.col(c) if isinstance(c, str) else c).alias(f"{name}{i}") for name, c in own.items()])
    on = (F.col("k1") == F.col("k2")) & (F.col("twos1") == F.col("twos2")) & (F.col("dense2") | (F.col("id1") < F.col("id2"))) & (F.col("root1") != F.col("root2"))
    # the least that need() and need_twos() can give; they themselves, much longer code, judge the counted pairs
    least = F.ceil(percent * (F.col("n1") + F.col("n2")) / F.lit(100 + percent) - 1e-9) - F.greatest("over1", "over2") + 1
    least = F.when(F.col("twos1"), F.greatest(F.lit(1), (least + 1) * least / 2)).otherwise(least)
    both = side(1).where("not dense1").withColumnRenamed("key", "k1").join(side(2).withColumnRenamed("key", "k2"), on & _compatible("n1", "n2", percent) & (least <= F.least("most1", "most2")))
    x, y, before = F.col("x"), F.col("y"), F.col("id1") < F.col("id2")
    pairs = both.select(F.least("id1", "id2").alias("a"), F.greatest("id1", "id2").alias("b"), F.col("twos1").alias("twos"), F.when(before, F.col("x1")).otherwise(F.col("x2")).alias("x"), F.when(before, F.col("x2")).otherwise(F.col("x1")).alias("y"))
    counted = pairs.groupBy("a", "b", "twos").agg(F.count("*").alias("lists"), F.first("x").alias("x"), F.first("y").alias("y"))
    return counted.where(F.col("lists") >= F.when(F.col("twos"), need_twos(x, y, percent)).otherwise(need(x, y, percent))).select("a", "b")


def candidates(short: DataFrame, heavy: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of sets with different roots whose lists in common can be enough for the threshold.

    ``short`` and ``heavy`` are the rows of short and long lists, with roots. Pairs of dense sets with a long list in
    common, which :func:`dense_links` has compared, are left out.
    """
    side = lambda i, *more: short.select("key", *more, F.struct("id", "n", "root").alias(f"x{i}"))
    fit = _compatible("x1.n", "x2.n", percent)
    pairs = side(1, "part").join(side(2), "key").where((F.col("x1.id") < F.col("x2.id")) & (F.col("x1.root") != F.col("x2.root")) & fit)
    counted = pairs.groupBy(F.col("x1.id").alias("a"), F.col("x2.id").alias("b")).agg(
        F.count_if(F.col("part") == -2).alias("twos"), F.count_if(F.col("part") > -2).alias("ones")
    )
    lists = ("lists", "lists2")
    for i, x in enumerate("ab"):
        counted = counted.join(facts.select(F.col("id").alias(x), F.struct(*[c for c in facts.columns if c not in ("id", *lists)]).alias(f"x{i}")), x)
    x, y = F.col("x0"), F.col("x1")
    kinds = (("ones", need(x, y, percent), ""), ("twos", need_twos(x, y, percent), "2"))
    reach = lambda count, wanted, of: (F.col(count) > 0) & (F.col(count) + F.least(x[f"longs{of}"], y[f"longs{of}"]) >= wanted)
    counted = counted.where(reach(*kinds[0]) | reach(*kinds[1]))
    for i, c in enumerate("ab"):
        counted = counted.join(facts.select(F.col("id").alias(c), F.struct(*lists).alias(f"l{i}")), c)

    def enough(count: str, wanted, of: str):
        p, q = F.col("l0")[f"lists{of}"], F.col("l1")[f"lists{of}"]
        common = F.size(F.array_intersect(p, q))
        compared = x[f"dense{of}"] & y[f"dense{of}"] & (common > 0)
        return reach(count, wanted, of) & F.when(p.isNotNull() & q.isNotNull(), ~compared & (F.col(count) + common >= wanted)).otherwise(True)

    return counted.where(enough(*kinds[0]) | enough(*kinds[1])).select("a", "b").union(counted_pairs(heavy, percent)).distinct()


def packed_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, pack): the compressed text for each (id, th) of ``wanted``."""
    words = FILTER_BITS // 64
    bit = F.pmod("th", F.lit(FILTER_BITS))
    rows = wanted.groupBy(F.shiftright(bit, 6).cast("int").alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(th, {FILTER_BITS}) & 63 as int))")).alias("bits")).collect()
    table = np.zeros(words, np.int64)  # FILTER_BITS in all, however many texts are wanted
    for r in rows:
        table[r["w"]] = r["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = shared.value, set()
        for batch in batches:
            th = batch.column("th").to_numpy()
            at = th % FILTER_BITS
            hit = np.flatnonzero((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1))
            texts, out = batch.column("text"), []
            for i in hit.tolist():
                if int(th[i]) not in known:
                    known.add(int(th[i]))
                    raw = (texts[i].as_py() or "").encode("utf-8", "replace")
                    out.append((int(th[i]), len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary()))], names=["th", "pack"])

    texts = docs.select("th", "text").mapInArrow(run, "th long, pack binary")
    return texts.join(wanted, "th").groupBy("id").agg(F.first("pack").alias("pack"))


def unpacked(pack: bytes, powers: Powers, k: int) -> np.ndarray:
    raw = pa.decompress(pack[8:], decompressed_size=int.from_bytes(pack[:8], "little"), codec="zstd", asbytes=True)
    return np.unique(shingles(word_hashes(raw, powers), k))


def check(pairs: DataFrame, packs: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b, link): the exact test of every pair."""
    side = lambda x: packs.select(F.col("id").alias(x), F.col("pack").alias(f"pack_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b")

    def start():
        powers, memo = Powers(), {}

        def set_of(key: int, pack) -> np.ndarray:
            if key not in memo:
                if len(memo) >= 256:
                    memo.clear()
                memo[key] = unpacked(pack.as_py(), powers, k)
            return memo[key]

        def work(batch: pa.RecordBatch):
            a, pa_, b, pb = (batch.column(c) for c in ("a", "pack_a", "b", "pack_b"))
            return [pa.array([linked(set_of(a[i].as_py(), pa_[i]), set_of(b[i].as_py(), pb[i]), percent) for i in range(batch.num_rows)], pa.bool_())]

        return work

    return add_columns(rows, "link boolean", start).select("a", "b", "link")


def link_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = K, percent: int = PERCENT) -> DataFrame:
    """(doc_id, th, n_shingles, component_id, first): each document's class; ``first`` marks one row of each class.

    ``th`` is the hash of the text; component_id the least doc_id of the class.
    """
    spark = docs.sparkSession
    t = F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(F.col(doc_id).alias("doc_id"), t.alias("text"), F.xxhash64(t).alias("th"))
    read = stored(read_sets(docs, k), "jaccard-sets")
    own = read.where("kind = 0").drop("kind")
    sets = own.where("n > 0").groupBy("a", "b", "n").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "th")).alias("rep"))
    sets = stored(sets, "jaccard-distinct")
    cells = np.zeros(CELLS, np.int64)
    for r in read.where("kind = 1").groupBy("n").agg(F.sum("a").alias("a")).collect():  # CELLS rows at most
        cells[r["n"]] = r["a"]
    level, parts, length = levels(cells)
    small = boundary({r["n"]: r["c"] for r in sets.where(F.col("n") <= 2 * MOST_SMALL).groupBy("n").agg(F.count("*").alias("c")).collect()}, length, percent)

    whole = Window.partitionBy("key", "part")
    lists = postings(docs, level, parts, small, k, percent).withColumns({"lo": F.min("id").over(whole), "hi": F.max("id").over(whole), "size": F.count("*").over(whole)})
    lists = lists.where("lo <> hi or part >= 0 or part = -3").drop("lo", "hi")
    longer = F.when((F.col("size") > LONG) | (F.col("part") >= 0), F.col("size")).otherwise(0)
    kept = stored(lists.withColumn("size", longer).distinct(), "jaccard-lists")
    lists = kept.where("part > -3")
    # of each set: size, marks, and the long lists of one shingle and of two that it is in
    ones, twos = (F.col("size") > 0) & (F.col("part") > -2), (F.col("size") > 0) & (F.col("part") == -2)
    facts = kept.groupBy("id").agg(
        F.max(F.when(F.col("part") > -3, F.col("n"))).alias("n"),
        *[F.max(F.when((F.col("part") == -3) & (F.col("n") == i), F.col("key"))).alias(m) for i, m in enumerate(_PLACES)],
        *[F.count_if(c).alias(name) for c, name in ((ones, "longs"), (twos, "longs2"))],
        *[F.sort_array(F.collect_list(F.when(c, F.col("key")))).alias(name) for c, name in ((ones, "lists"), (twos, "lists2"))],
    )
    fewer = lambda c: F.when(F.size(c) <= ARRAY, F.col(c))
    itself = {c: F.col(c) for c in ("n", *_PLACES)}
    dense = {"dense": (F.col("longs") > 0) & (need(itself, itself, percent) <= F.col("longs")), "dense2": (F.col("longs2") > 0) & (need_twos(itself, itself, percent) <= F.col("longs2"))}
    facts = stored(facts.where("n is not null").withColumns({c: fewer(c) for c in ("lists", "lists2")} | dense), "jaccard-facts")
    heavy = lists.where("size > 0").join(facts.drop("n", "lists", "lists2"), "id")
    heavy = stored(heavy.withColumn("dense", F.when(F.col("part") == -2, F.col("dense2")).otherwise(F.col("dense"))).drop("dense2"), "jaccard-long")
    reps = sets.select(F.col("a").alias("id"), F.col("rep.th").alias("th"))

    def packs_of(ids: DataFrame) -> DataFrame:
        return stored(packed_texts(docs, stored(reps.join(ids, "id", "left_semi"), "jaccard-wanted")), "jaccard-packs")

    def tested(pairs: DataFrame, packs: DataFrame) -> DataFrame:
        return stored(check(pairs, packs, k, percent), "jaccard-checked").where("link").select("a", "b")

    def ids(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()

    edges = lambda r: r.select(F.col("id").alias("a"), F.col("root").alias("b"))
    roots = spark.createDataFrame([], "id long, root long")
    for turn in range(TURNS):
        pairs = stored(star_pairs(with_roots(heavy, roots), turn, percent), "jaccard-pairs")
        packs = packs_of(ids(pairs))
        roots = components(edges(roots).union(tested(pairs, packs)))
        forget(packs)
    members = stored(bundles(with_roots(heavy, roots)), "jaccard-members")
    packs = packs_of(members.select("id").distinct())
    roots = components(edges(roots).union(stored(dense_links(members, packs, k, percent), "jaccard-blocks")))
    forget(packs)
    pairs = stored(candidates(with_roots(lists.where("size <= 0"), roots), with_roots(heavy, roots), facts, percent), "jaccard-pairs")
    forget(kept)
    packs = packs_of(ids(pairs))
    roots = components(edges(roots).union(tested(pairs, packs)))
    forget(packs)

    rooted = sets.join(roots.withColumnRenamed("id", "a"), "a", "left").withColumn("root", F.coalesce("root", "a"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("least"))
    named = rooted.join(least, "root").select(F.col("a").alias("sa"), F.col("b").alias("sb"), "least")
    in_sets = own.where("n > 0").join(named, (F.col("a") == F.col("sa")) & (F.col("b") == F.col("sb")))
    first = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("th") == F.col("least.th"))
    in_sets = in_sets.select("doc_id", "th", F.col("n").alias("n_shingles"), F.col("least.doc_id").alias("component_id"), first.alias("first"))
    alone = own.where("n = 0").select("doc_id", "th", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return in_sets.unionByName(alone)


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each class: the first id's; rows without words all stay."""
    classes = link_classes(docs, text, doc_id, **options).where("first").select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), (F.col("n_shingles") > 0).alias("__in")).distinct()
    rows = docs.withColumn("__text", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    rows = rows.join(classes, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__th")))
    single = F.when(F.col("__in"), F.lit(-1)).otherwise(F.monotonically_increasing_id())
    return rows.withColumn("__row", single).dropDuplicates([doc_id, "__text", "__row"]).select(*docs.columns)
