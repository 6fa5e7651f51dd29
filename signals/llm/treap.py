"""Ranked lexical search with K2-treaps over the term-document grid.

Documents are cut into blocks of about ``BLOCK_BYTES`` of text. A block's grid
has a row for each term (frequent first) and a column for each document (short
first); a filled place holds the term's impact in the document, the part of
its score that doesn't depend on the item. The grid is a compressed quadtree:
a cell is a quarter of its parent, empty cells are left out, a cell with one
filled place is not divided further, children are found by counting the bits
of the masks before, and every cell keeps the largest impact inside it.

A search walks down from the root over document ranges. For each range it
holds, for each of the item's terms, the cell on that term's row path; the sum
of weight times cell maximum bounds every score in the range. Ranges go best
bound first, in small batches, until no bound reaches the worst of the k best
scores found, which a task carries from block to block. All terms and
documents are indexed, and the result is exact.

Tables: ``blocks`` (counts, one pass over the texts) and the treaps themselves
are stored in the shared folder, a row for each block. What reaches the driver
are two totals and, for at most ``ITEM_BYTES`` of items at a time, their terms
and document frequencies; more items are searched in as many passes.

Defined results: null and empty texts, and texts without a term, are in no
block and count for nothing; an item without terms, or with a null text, gets
no rows; very long texts make a block of their own; repeated documents rank
each for itself, and repeated items are answered each; equal scores go by
document id, null ids first; empty tables give an empty result; only the named
columns of either table are read, so others may have any name.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signals.llm.common import forget, stored

BLOCK_BYTES = 8 << 20  # of text in a block
ITEM_BYTES = 16 << 20  # of items' texts in a pass
BATCH = 4096  # row paths moved at a time
SALTS = 64

#: Bytes of terms: digits, letters (A-Z lower-cased) and all beyond ASCII; the rest separates.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BITS = np.array([bin(i).count("1") for i in range(16)], np.int64)

_BLOCK = "doc_ids array<bigint>, lengths array<bigint>, terms array<binary>, dfs array<bigint>, places binary, n_docs bigint, n_terms bigint"
_TREAP = "doc_ids array<bigint>, terms array<binary>, dfs array<bigint>, height int, masks binary, maxima binary, alone binary"
#: Parquet looks at its buffers after each of these large rows, not after a hundred.
_WRITE = {"parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1", "parquet.block.size": str(32 << 20)}


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_TABLE).split()


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"array<bigint>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary()), "binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def _row(schema: pa.Schema, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def _block(ids: list, tokens: list[bytes], lengths: list[int]):
    """The counts of a block: ids and lengths of its documents, terms and their document frequencies, and (row, column, count)."""
    n = np.array(lengths, np.int64)
    order = np.argsort(n, kind="stable")
    column = np.empty(len(n), np.int64)
    column[order] = np.arange(len(n))
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    terms, size = coded.dictionary, len(coded.dictionary)
    key, tf = np.unique(np.repeat(column, n) * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    column, term = np.divmod(key, size)
    df = np.bincount(term, minlength=size)
    by_df = np.argsort(-df, kind="stable")
    row = np.empty(size, np.int64)
    row[by_df] = np.arange(size)
    places = np.concatenate([row[term].astype(np.int32), column.astype(np.int32), tf.astype(np.int32)])
    return [ids[i] for i in order], n[order], terms.take(pa.array(by_df)).to_pylist(), df[by_df], places.tobytes(), len(ids), int(n.sum())


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of numbers below 2^32 moved to the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def quadtree(row: np.ndarray, column: np.ndarray, value: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(height, masks, maxima, places of the cells left whole) of a grid's filled places, cells level by level."""
    height = max(1, int(max(row.max(), column.max())).bit_length())
    code = (_spread(row) << np.uint64(1)) | _spread(column)
    order = np.argsort(code)
    code, row, column, value = code[order], row[order], column[order], value[order]
    masks, maxima, alone = [], [], []
    first, count = np.zeros(1, np.int64), np.array([len(code)])
    for level in range(height + 1):
        single = count == 1
        alone.append(first[single])
        maxima.append(np.maximum.reduceat(value, first) if level == 0 else most)
        mask = np.zeros(len(first), np.uint8)
        if not single.all():
            inner = count[~single]
            ends = np.cumsum(inner)
            at = np.repeat(first[~single] - (ends - inner), inner) + np.arange(ends[-1])
            cell = code[at] >> np.uint64(2 * (height - level - 1))
            start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            most = np.maximum.reduceat(value[at], start)
            quarter, parent = (cell[start] & np.uint64(3)).astype(np.uint8), cell[start] >> np.uint64(2)
            of_parent = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            mask[~single] = np.bitwise_or.reduceat(np.uint8(1) << quarter, of_parent)
            first, count = at[start], np.diff(np.append(start, len(at)))
            masks.append(mask)
        else:
            masks.append(mask)
            break
    alone = np.concatenate(alone)
    return height, np.concatenate(masks), np.concatenate(maxima).astype(np.int32), np.concatenate([row[alone], column[alone]]).astype(np.int32)


class Treap:
    """A stored quadtree with its child pointers; one cell more stands for all empty ones."""

    def __init__(self, height: int, masks: bytes, maxima: bytes, alone: bytes):
        self.height = height
        mask = np.frombuffer(masks, np.uint8)
        self.none = len(mask)
        self.mask = np.append(mask, np.uint8(0))
        self.most = np.append(np.frombuffer(maxima, np.int32), 0).astype(np.int64)
        sizes = _BITS[self.mask]
        self.child = 1 + np.cumsum(sizes) - sizes
        self.row, self.column = np.full(self.none + 1, -1, np.int32), np.full(self.none + 1, -1, np.int32)
        leaf = np.flatnonzero(mask == 0)
        self.row[leaf], self.column[leaf] = np.frombuffer(alone, np.int32).reshape(2, -1)

    def start(self, rows: np.ndarray) -> np.ndarray:
        """The root's cell for each row."""
        return np.where((self.mask[0] != 0) | (self.row[0] == rows), 0, self.none)[None, :]

    def halves(self, cells: np.ndarray, rows: np.ndarray, level: int) -> np.ndarray:
        """The cells of the left halves of document ranges, then those of the right ones; level: of ``cells``."""
        bit = self.height - 1 - level
        cells = np.concatenate([cells, cells])
        right = (np.arange(len(cells)) >= len(cells) // 2)[:, None]
        quarter = 2 * ((rows >> bit) & 1)[None, :] + right
        mask = self.mask[cells].astype(np.int64)
        below = self.child[cells] + _BITS[mask & ((1 << quarter) - 1)]
        stays = (mask == 0) & (((self.column[cells] >> bit) & 1) == right)
        cells = np.where((mask >> quarter) & 1, below, np.where(stays, cells, self.none))
        return np.where((self.mask[cells] == 0) & (self.row[cells] != rows), self.none, cells)


class Best:
    """The k best (score, id) so far, equal scores by id with null first; ``floor``: what a score needs to matter."""

    def __init__(self, k: int):
        self.k, self.floor = k, 1
        self.score, self.id, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        score, ids, known = np.concatenate([self.score, score]), np.concatenate([self.id, ids]), np.concatenate([self.known, known])
        best = np.lexsort((ids, known, -score))[: self.k]
        self.score, self.id, self.known = score[best], ids[best], known[best]
        if len(best) == self.k:
            self.floor = max(1, int(self.score[-1]))


def descend(treap: Treap, rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, known: np.ndarray, best: Best) -> int:
    """Bring a block's documents into ``best``; the number of document ranges looked at."""
    width = max(4, BATCH // len(rows))
    cells = treap.start(rows)
    bound = treap.most[cells] @ weights
    heap, turn, seen = [(-int(bound[0]), 0, 0, bound, np.zeros(1, np.int64), cells)], 0, 0
    while heap:
        top, _, level, bound, column, cells = heapq.heappop(heap)
        if -top < best.floor:
            break
        if len(bound) > width:
            turn += 1
            heapq.heappush(heap, (-int(bound[width]), turn, level, bound[width:], column[width:], cells[width:]))
            bound, column, cells = bound[:width], column[:width], cells[:width]
        seen += len(bound)
        if level == treap.height:
            best.add(bound, ids[column], known[column])
            continue
        cells = treap.halves(cells, rows, level)
        column = np.concatenate([2 * column, 2 * column + 1])
        bound = treap.most[cells] @ weights
        good = np.flatnonzero(bound >= best.floor)
        if len(good):
            good = good[np.argsort(-bound[good], kind="stable")]
            turn += 1
            heapq.heappush(heap, (-int(bound[good[0]]), turn, level + 1, bound[good], column[good], cells[good]))
    return seen


def count_blocks(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row of counts for each block of documents that have a term."""
    schema = _arrow(_BLOCK)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, tokens, lengths, size = [], [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                found = terms_of(t.as_py() or b"")
                if found:
                    ids.append(i)
                    tokens += found
                    lengths.append(len(found))
                    size += len(t.as_py())
                if size >= block_bytes:
                    yield _row(schema, *_block(ids, tokens, lengths))
                    ids, tokens, lengths, size = [], [], [], 0
        if ids:
            yield _row(schema, *_block(ids, tokens, lengths))

    return docs.select(F.col(doc_id).cast("long"), text).mapInArrow(run, _BLOCK)


class Index:
    """The stored treaps of all blocks, and the number of documents with a term."""

    def __init__(self, table: DataFrame, n_docs: int):
        self.table, self.n_docs = table, n_docs


def index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> Index:
    """Index every row of ``docs``."""
    blocks = stored(count_blocks(docs, text, doc_id, block_bytes), "treap-blocks", _WRITE)
    total = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    n_docs, n_terms = total["n"], total["l"]
    schema = _arrow(_TREAP)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, lengths, terms, dfs, places = (batch.column(i).slice(at, 1) for i in range(5))
                row, column, tf = np.frombuffer(places[0].as_buffer(), np.int32).reshape(3, -1).astype(np.int64)
                # python's own integers: 50 * n * N may pass 64 bits on the way
                damping = np.array([20 * (50 + 50 * n * n_docs // n_terms) for n in lengths[0].as_py()], np.int64)
                impact = (1_000_000_000 * tf) // (1000 * tf + damping[column])
                height, *tree = quadtree(row, column, impact)
                yield pa.RecordBatch.from_arrays([ids, terms, dfs, pa.array([height], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in tree)], schema=schema)

    table = stored(blocks.select("doc_ids", "lengths", "terms", "dfs", "places").mapInArrow(run, _TREAP), "treaps", _WRITE)
    forget(blocks)
    return Index(table, n_docs)


def _frequencies(index: Index, terms: list[bytes]) -> dict[bytes, int]:
    """In how many documents each of the terms is, from the treaps' vocabularies."""
    shared = index.table.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(shared.value, pa.binary())
        total = np.zeros(len(asked), np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                place = pc.index_in(asked, batch.column(0)[at].values)
                held = place.is_valid().to_numpy(zero_copy_only=False)
                total[held] += batch.column(1)[at].values.to_numpy()[place.drop_null().to_numpy()]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([asked.take(pa.array(held)), pa.array(total[held])], names=["term", "df"])

    rows = index.table.select("terms", "dfs").mapInArrow(run, "term binary, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect()
    shared.unpersist()
    return {bytes(r["term"]): r["df"] for r in rows}


def _found(index: Index, asked: list[tuple[int, list[bytes]]], k: int) -> DataFrame:
    """(item, score, doc_id): each task's k best for each item."""
    df = _frequencies(index, sorted({t for _, terms in asked for t in terms}))
    weight = {t: math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    asked = [(item, [t for t in terms if weight.get(t)]) for item, terms in asked]
    shared = index.table.sparkSession.sparkContext.broadcast(([x for x in asked if x[1]], weight))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = shared.value
        every = pa.array(list(weight), pa.binary())
        weights = np.array(list(weight.values()), np.int64)
        place = {t: i for i, t in enumerate(weight)}
        items = [(item, np.array([place[t] for t in terms]), Best(k)) for item, terms in asked]
        for batch in batches:
            for at in range(batch.num_rows):
                ids, terms, height, *tree = (batch.column(i)[at] for i in range(batch.num_columns))
                treap = Treap(height.as_py(), *(x.as_buffer() for x in tree))
                known = ids.values.is_valid().to_numpy(zero_copy_only=False)
                ids = ids.values.fill_null(0).to_numpy(zero_copy_only=False)
                row = pc.index_in(every, terms.values).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                for _, own, best in items:
                    held = own[row[own] >= 0]
                    if len(held):
                        descend(treap, row[held], weights[held], ids, known, best)
        for item, _, best in items:
            ids = pa.array(best.id, mask=~best.known)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item, np.int64)), pa.array(best.score), ids], names=["item", "score", "doc_id"])

    columns = ["doc_ids", "terms", "height", "masks", "maxima", "alone"]
    return index.table.select(*columns).mapInArrow(run, "item bigint, score bigint, doc_id bigint")


def search(index: Index, items: DataFrame, k: int, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest score above 0 for each row of ``items``."""
    numbered = stored(items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).withColumn("item", F.monotonically_increasing_id()), "treap-items")
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = 1 + size // ITEM_BYTES
    found = None
    for i in range(passes):
        own = numbered.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == i).select("item", "text").collect()
        asked = [(r["item"], sorted(set(terms_of((r["text"] or "").encode())))) for r in own]
        more = _found(index, [x for x in asked if x[1]], k)
        more = more if passes == 1 else stored(more, "treap-found")
        found = more if found is None else found.union(more)
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    # a task gives at most k rows for an item; an item's rows of very many tasks meet in two steps
    salted = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*order)
    best = found.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
