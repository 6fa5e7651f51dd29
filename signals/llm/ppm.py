"""Language-model scores by prediction by partial matching (PPM) over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes long with the counts
of the symbol after each. A symbol is predicted in the longest context that is
known; where it never followed, the model escapes (method C: with weight one
for each distinct symbol seen there) to the context one byte shorter, whose
symbols seen above are excluded, and at last to all remaining bytes alike. A
text ends with an end symbol. A-Z are lower-cased first.

Pretrained scores: every training document is counted in Spark. A count of
(context, symbol) at the top order fixes all shorter ones. The trie is cut
into blocks of contexts that share their last two bytes, at most ``NODES``
counts each; one block after the other is broadcast and the positions in its
contexts are scored, so a larger trie means more passes, not more memory.
Adaptive scores (``adaptive``) learn from each document alone as they go.

The unigram base counts words by 64-bit hashes. Words with high counts (a
bounded number, ``FREQUENT``) are broadcast; all other words are looked up by a
join on their hash, so every word has its exact count.

Defined results: a null text is empty, its only token and symbol is the end;
without training documents the base has N = V = 0 and every symbol costs the
same; repeated rows are scored, and if they train, counted, each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.llm.common import add_columns, aside, stored
from signals.llm.hashing import Powers, word_hashes

ORDER = 5
NODES = 4_000_000
FREQUENT = 1 << 20
#: Bytes of text that are worked on at a time.
CHUNK = 1 << 20
#: Distinct counts that a counting task holds before it hands them on.
HELD = 1_000_000
#: The end of a text among the words' hashes.
END = 0x5EED0E4D

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts in UTF-8) of runs of texts of about ``CHUNK`` bytes."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append((t or "").encode("utf-8", "replace"))
        size += len(held[-1])
        if size >= CHUNK:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol of each text (its bytes and the end, 0): context and symbol packed, latest byte lowest; the text's index."""
    pad = bytes(order)
    b = _LOWER[np.frombuffer(pad + pad.join(texts) + bytes(max(order, 1)), np.uint8)]
    lengths = np.array([len(t) for t in texts], np.int64)
    of = np.repeat(np.arange(len(texts)), lengths + 1)
    at = np.arange(len(of)) + of * (order - 1) + order  # each text is followed by its end and order - 1 more zeros
    key = np.zeros(len(b), np.uint64)
    for i in range(order + 1):
        key[i:] |= b[: len(b) - i].astype(np.uint64) << np.uint64(8 * i)
    return key[at], of


class Counts:
    """Counts by key, merged as they come."""

    def __init__(self):
        self.keys, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        k, n = np.unique(keys, return_counts=True)
        k, n = np.concatenate([self.keys, k]), np.concatenate([self.n, n])
        order = np.argsort(k, kind="stable")
        k, n = k[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
        self.keys, self.n = k[first], np.add.reduceat(n, first) if len(k) else n

    def batch(self, kind: int) -> pa.RecordBatch:
        arrays = [pa.array(np.full(len(self.keys), kind, np.int32)), pa.array(self.keys.view(np.int64)), pa.array(self.n)]
        self.__init__()
        return pa.RecordBatch.from_arrays(arrays, names=["kind", "key", "n"])


def count(docs: DataFrame, text: str = "text", order: int = ORDER) -> DataFrame:
    """(kind, key, n) over all rows: kind 0 counts packed contexts with symbols, kind 1 words' hashes with the end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, tables, waiting = Powers(), (Counts(), Counts()), ([], [])
        for batch in batches:
            for _, texts in chunks(batch.column(0).to_pylist()):
                ends = np.full(len(texts), END, np.uint64)
                waiting[0].append(grams(texts, order)[0])
                waiting[1].append(np.concatenate([*[word_hashes(t, powers) for t in texts], ends]))
                for kind, (table, held) in enumerate(zip(tables, waiting)):
                    if sum(map(len, held)) > 2 * CHUNK:
                        table.add(np.concatenate(held))
                        held.clear()
                    if len(table.keys) > HELD:
                        yield table.batch(kind)
        for kind, (table, held) in enumerate(zip(tables, waiting)):
            if held:
                table.add(np.concatenate(held))
            yield table.batch(kind)

    parts = docs.select(text).mapInArrow(run, "kind int, key long, n long")
    return parts.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the sum of their values, how many they were."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(values, first) if len(keys) else values
    return keys[first], sums, np.diff(np.append(first, len(keys)))


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and whether they are there."""
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)


def trie(keys: np.ndarray, n: np.ndarray, short: tuple[np.ndarray, np.ndarray], order: int) -> dict:
    """A block of the trie as arrays, by order k.

    ``grams[k]``, ``n[k]``: (context, symbol) counts. ``contexts[k]`` with, for
    the level that a symbol is first tried in, ``den`` and ``esc`` (log10 of
    the weights' sum and of the escape's share) and, for the level below after
    an escape from here, ``den_below`` and ``esc_below``, with what was seen
    here excluded. ``short`` has the order-1 counts of the whole trie.
    """
    out: dict = {x: [None] * (order + 1) for x in ("grams", "n", "contexts", "den", "esc", "den_below", "esc_below")}
    sums: list = [None] * (order + 1)
    for k in range(order, -1, -1):
        if k == min(1, order):
            keys, n = short  # from here on, contexts may end in any bytes
        mask = np.uint64((1 << 8 * (k + 1)) - 1)
        out["grams"][k], out["n"][k], _ = _grouped(keys & mask, n)
        out["contexts"][k], total, distinct = _grouped(out["grams"][k] >> np.uint64(8), out["n"][k])
        sums[k] = (total, distinct)
        out["den"][k] = np.log10(total + distinct)
        out["esc"][k] = np.log10(distinct) - out["den"][k]
    for k in range(1, order + 1):
        below = np.uint64((1 << 8 * k) - 1)
        at, _ = _find(out["grams"][k - 1], out["grams"][k] & below)  # the same symbol in the shorter context
        owner = np.searchsorted(out["contexts"][k], out["grams"][k] >> np.uint64(8))
        seen = np.bincount(owner, weights=out["n"][k - 1][at], minlength=len(out["contexts"][k]))
        up, _ = _find(out["contexts"][k - 1], out["contexts"][k] & (below >> np.uint64(8)))
        rest = sums[k - 1][0][up] - seen
        fresh = sums[k - 1][1][up] - sums[k][1]
        some = fresh > 0
        out["den_below"][k] = np.log10(np.where(some, rest + fresh, 1.0))
        out["esc_below"][k] = np.where(some, np.log10(np.maximum(fresh, 1)) - out["den_below"][k], 0.0)
    out["den_below"][0] = np.log10(np.maximum(256 - sums[0][1], 1))
    return out


class Scorer:
    """log10 probabilities of packed (context, symbol) keys under one block."""

    def __init__(self, block: dict):
        self.block, self.order = block, len(block["grams"]) - 1
        top, n = block["grams"][-1], block["n"][-1]
        at, _ = _find(block["contexts"][-1], top >> np.uint64(8))
        self.bits = max(10, (len(top) * 4 // 3).bit_length())  # at most three quarters full
        self.keys, self.values = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, np.nan, np.float32)
        left = np.arange(len(top))
        probability, slot = np.log10(n) - block["den"][-1][at], self._slot(top)
        while len(left):  # open addressing: each free slot takes one of the keys that want it
            want = slot[left]
            free = np.isnan(self.values[want])
            self.keys[want[free]], self.values[want[free]] = top[left[free]], probability[left[free]]
            left = left[self.keys[want] != top[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
        block["grams"][-1], block["n"][-1] = top[:0].copy(), n[:0].copy()  # the table has them now

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def score(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out, found = self.values[slot].astype(np.float64), self.keys[slot]
        left = np.flatnonzero((found != keys) & ~np.isnan(out))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            s = slot[left]
            out[left] = self.values[s]
            left = left[(self.keys[s] != keys[left]) & ~np.isnan(self.values[s])]
        missed = np.flatnonzero(np.isnan(out))
        out[missed] = self._escaped(keys[missed])
        return out

    def _escaped(self, keys: np.ndarray) -> np.ndarray:
        """Of symbols that never followed in their longest context."""
        b, out, open_ = self.block, np.zeros(len(keys)), np.ones(len(keys), bool)
        above = np.full(len(keys), -1)  # place of the longer context that was escaped from
        for k in range(self.order, -1, -1):
            key = keys & np.uint64((1 << 8 * (k + 1)) - 1)
            context, known = _find(b["contexts"][k], key >> np.uint64(8))
            if not len(b["contexts"][k]):
                continue
            gram, there = _find(b["grams"][k], key)
            below = b["den_below"][k + 1][above] if k < self.order and len(b["contexts"][k + 1]) else 0.0
            fall = b["esc_below"][k + 1][above] if k < self.order and len(b["contexts"][k + 1]) else 0.0
            den = np.where(above >= 0, below, b["den"][k][context])
            esc = np.where(above >= 0, fall, b["esc"][k][context])
            hit = open_ & known & there
            out += np.where(open_ & known & ~there, esc, 0.0)
            out[hit] += np.log10(b["n"][k][gram[hit]]) - den[hit]
            open_ &= ~hit
            above = np.where(known, context, -1)
        last = b["den_below"][0][0] if len(b["contexts"][0]) else np.log10(256)
        return out - np.where(open_, last, 0.0)


def _two(key: Column) -> Column:
    """The last two bytes of a packed key's context."""
    return F.shiftrightunsigned(key, 8).bitwiseAND(0xFFFF)


def blocks(counts: DataFrame, order: int = ORDER, nodes: int = NODES) -> Iterator[tuple[set[int] | None, dict]]:
    """The trie in blocks: the last two context bytes that a block covers (None: all), and its arrays."""
    top = counts.where("kind = 0")
    sizes = sorted((r["two"], r["n"]) for r in top.groupBy(_two(F.col("key")).alias("two")).agg(F.count("*").alias("n")).collect())  # 2^16 rows at most
    pair = top.groupBy(F.col("key").bitwiseAND(0xFFFF if order else 0xFF).alias("key")).agg(F.sum("n").alias("n")).toArrow()  # as many
    short = pair["key"].to_numpy().view(np.uint64), pair["n"].to_numpy()
    groups: list[list[int]] = [[]]
    held = 0
    for two, n in sizes:
        if groups[-1] and held + n > nodes:
            groups.append([])
            held = 0
        groups[-1].append(two)
        held += n
    for group in groups:
        if len(groups) == 1:
            part, covers = top, None
        else:  # a range of the last two bytes
            part, covers = top.where(_two(F.col("key")).between(group[0], group[-1])), (group[0] if group is not groups[0] else 0, groups[groups.index(group) + 1][0] if group is not groups[-1] else 1 << 16)
        table = part.select("key", "n").toArrow()
        yield covers, trie(table["key"].to_numpy().view(np.uint64), table["n"].to_numpy(), short, order)


def frequent(counts: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of the words whose count reaches the least power of two that at most ``most`` reach."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = {r["level"]: r["n"] for r in counts.where("kind = 1").groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    least, held = 64, 0
    while least > 0 and held + sizes.get(least - 1, 0) <= most:
        least -= 1
        held += sizes.get(least, 0)
    table = counts.where(F.col("kind") == 1).where(F.col("n") >= F.lit(1 << min(least, 62))).select("key", "n").toArrow()
    keys, n = table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def _scorer(block: dict) -> Scorer:
    """The block's scorer, made once for all tasks of a Python worker."""
    block["scorer"] = block.get("scorer") or Scorer(block)
    return block["scorer"]


def _scored(scorer: Scorer, covers: tuple[int, int] | None, texts: list[bytes]) -> np.ndarray:
    """For each text the log10 probability of its symbols whose contexts' last two bytes are in the range."""
    keys, of = grams(texts, scorer.order)
    if covers:
        two = keys >> np.uint64(8) & np.uint64(0xFFFF)
        here = (two >= covers[0]) & (two < covers[1])
        keys, of = keys[here], of[here]
    return np.bincount(of, weights=scorer.score(keys), minlength=len(texts))


def block_scores(docs: DataFrame, block: dict, covers: tuple[int, int] | None, text: str = "text", out: str = "score") -> DataFrame:
    """Add to every row what one block of the trie gives."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def start():
        scorer = _scorer(shared.value)

        def work(batch: pa.RecordBatch):
            parts = [_scored(scorer, covers, texts) for _, texts in chunks(batch.column(text).to_pylist())]
            return [pa.array(np.concatenate(parts) if parts else np.zeros(0))]

        return work

    return add_columns(docs, f"{out} double", start)


def score(docs: DataFrame, train: Column, text: str = "text", order: int = ORDER, nodes: int = NODES, most: int = FREQUENT) -> DataFrame:
    """Add n_tokens, n_known, train_tokens, base_score and score to every row; learns from the rows where ``train`` holds."""
    spark = docs.sparkSession
    names, learning = docs.columns, docs.where(train)
    docs, moved = aside(docs, ("rare", "times", "more", "less", "key", "part"))
    keep = [c for c in docs.columns if c not in ("n_tokens", "n_known", "train_tokens", "base_score", "score")]
    counts = stored(count(learning, text, order), "ppm-counts")
    sizes = counts.where("kind = 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, ground = sizes["n"], np.log10(sizes["n"] + 0.1 * (sizes["v"] + 1))
    common = spark.sparkContext.broadcast(frequent(counts, most))
    parts = blocks(counts, order, nodes)
    covers, block = next(parts)
    shared = spark.sparkContext.broadcast(block)
    del block

    def start():
        powers, (keys, n), scorer = Powers(), common.value, _scorer(shared.value)

        def work(batch: pa.RecordBatch):
            tokens, known, base, model, rare, times = [], [], [], [], [], []
            for _, texts in chunks(batch.column(text).to_pylist()):
                model.append(_scored(scorer, covers, texts))
                hashes = [np.append(word_hashes(t, powers), np.uint64(END)) for t in texts]
                sizes = np.array([len(h) for h in hashes])
                distinct, back = np.unique(np.concatenate(hashes), return_inverse=True)
                at, there = _find(keys, distinct)
                value = np.where(there, np.log10(n[at] + 0.1) - ground if len(n) else 0.0, 0.0)
                of = np.repeat(np.arange(len(texts)), sizes)
                base.append(np.bincount(of, weights=value[back], minlength=len(texts)))
                known.append(np.bincount(of, weights=there[back], minlength=len(texts)).astype(np.int64))
                tokens.append(sizes)
                missing = ~there[back]
                for r in np.split(distinct[back[missing]], np.cumsum(np.bincount(of[missing], minlength=len(texts)))[:-1]):
                    k, c = np.unique(r, return_counts=True)
                    rare.append(k.view(np.int64))
                    times.append(c.astype(np.int32))
            joined = lambda x, kind: pa.array(np.concatenate(x).astype(kind)) if x else pa.array([], pa.from_numpy_dtype(kind))
            ends = pa.array(np.cumsum([0, *map(len, rare)]).astype(np.int32))
            return [joined(tokens, np.int64), joined(known, np.int64), joined(base, np.float64), joined(model, np.float64), pa.ListArray.from_arrays(ends, joined(rare, np.int64)), pa.ListArray.from_arrays(ends, joined(times, np.int32))]

        return work

    first = add_columns(docs.select(*keep), "n_tokens long, n_known long, base_score double, score double, rare array<long>, times array<int>", start)
    texts = [F.xxhash64(F.lit(s), F.coalesce(F.col(text), F.lit(""))) for s in (1, 2)]
    rows = stored(first.select(F.monotonically_increasing_id().alias("__row"), *[t.alias(f"__t{i}") for i, t in enumerate(texts)], *[c for c in keep if c != text], "n_tokens", "n_known", "base_score", "score", "rare", "times"), "ppm-rows")

    words = rows.select("__row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("__row", F.col("w.rare").alias("key"), F.col("w.times").alias("times"))
    learned = counts.where("kind = 1").select("key", "n")
    looked = words.join(learned, "key", "left").groupBy("__row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 0.1) - float(ground))).alias("less"),
    )
    result = rows.drop("rare", "times").join(looked, "__row", "left")
    for covers, block in parts:  # more blocks: sums by text, equal texts once
        more = block_scores(docs.select(*[t.alias(f"__u{i}") for i, t in enumerate(texts)], text), block, covers, text, "part")
        more = stored(more.groupBy("__u0", "__u1").agg(F.first("part").alias("part")), "ppm-part")
        result = result.join(more, (F.col("__t0") == F.col("__u0")) & (F.col("__t1") == F.col("__u1"))).withColumn("score", F.col("score") + F.col("part")).drop("part", "__u0", "__u1")
    return result.select(
        *[F.col(moved.get(c, c)).alias(c) for c in names if moved.get(c, c) in keep and c != text],
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("less", F.lit(0.0))).alias("base_score"),
        "score",
    )


class AdaptiveTrie:
    """Counts that grow with every symbol; plain Python, a document at a time."""

    def __init__(self, order: int):
        self.order, self.counts = order, {}

    def log10p(self, context: bytes, symbol: int) -> float:
        total, excluded = 0.0, set()
        for k in range(self.order, -1, -1):
            seen = self.counts.get(context[len(context) - k :])
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in excluded}
            if left:
                weight = sum(left.values()) + len(left)
                if symbol in left:
                    return total + float(np.log10(left[symbol] / weight))
                total += float(np.log10(len(left) / weight))
            excluded |= set(seen)
        return total - float(np.log10(256 - len(excluded)))

    def learn(self, context: bytes, symbol: int) -> None:
        for k in range(self.order + 1):
            seen = self.counts.setdefault(context[len(context) - k :], {})
            seen[symbol] = seen.get(symbol, 0) + 1

    def read(self, text: str | None, learn: bool = True) -> float:
        """log10 probability of a text and its end."""
        b = bytes(self.order) + _LOWER[np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)].tobytes() + b"\0"
        total = 0.0
        for i in range(self.order, len(b)):
            context = b[i - self.order : i]
            total += self.log10p(context, b[i])
            if learn:
                self.learn(context, b[i])
        return total


def adaptive(docs: DataFrame, text: str = "text", order: int = ORDER, out: str = "score") -> DataFrame:
    """Add each row's log10 probability under a trie that learns from the row's text alone, as it reads."""

    def start():
        return lambda batch: [pa.array([AdaptiveTrie(order).read(t) for t in batch.column(text).to_pylist()], pa.float64())]

    return add_columns(docs, f"{out} double", start)
