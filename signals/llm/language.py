"""Language identification with blended-spectrum string kernels.

A text is the set of its byte n-grams of lengths 1 to 3 (lower case, what
isn't a letter read as one space). The kernel of two texts is the number of
n-grams they share over the root of the product of their set sizes, within the
n-grams of the landmarks. Landmarks are a few training texts of each language;
Nyström's map K_mm^(-1/2) of the kernels with them gives features, on which
one ridge regression per language separates it from the rest. The map and the
weights fold into one matrix, so a batch of texts is scored by two products.

The fit uses a bounded sample: up to ``PER_LANG`` labelled training texts of
each language, ``LANDMARKS`` of them landmarks, taken by seeded hash over the
whole table; whole texts are used. Only sets of n-grams reach the driver. All
rows are scored.

Defined results: null text or one without a letter gives ``und`` and score 0;
a null language is never learned; without training rows everything is ``und``;
ties go to the language first in order; repeated rows are scored alike.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.llm.common import add_columns

PER_LANG = 300
LANDMARKS = 24  # for each language
RIDGE = 1e-2
SHARPNESS = 4.0
ROWS = 256  # of a product
#: More languages than this are refused: the sample is bounded by PER_LANG of each.
MAX_LANGS = 500

HAS_LETTER = re.compile(r"[^\W\d_]")
_IS_LETTER = np.array([c if (97 <= c <= 122 or c >= 128) else 32 for c in range(256)], np.uint8)
#: Codes: 3-grams, then 2-grams, then single bytes.
_TWO, _ONE, _ALL = 1 << 24, (1 << 24) + (1 << 16), (1 << 24) + (1 << 16) + 256


def codes(text: str) -> np.ndarray:
    """The n-grams of a text as numbers, with repeats."""
    b = _IS_LETTER[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])].astype(np.int32)
    two = (b[:-1] << 8) | b[1:]
    return np.concatenate([(two[:-1] << 8) | b[2:], two + _TWO, b + _ONE])


class Model:
    """Landmark n-grams and the folded weights; made from (language, n-gram codes) samples."""

    def __init__(self, samples: list[tuple[str, np.ndarray]]):
        self.langs = sorted({lang for lang, _ in samples})
        marks, seen = [], dict.fromkeys(self.langs, 0)
        for lang, c in samples:
            if seen[lang] < LANDMARKS:
                seen[lang] += 1
                marks.append(c)
        self.grams = np.unique(np.concatenate(marks)) if marks else np.zeros(0, np.int32)
        if not self.langs:
            return
        place = self.table()
        sets = lambda cs: self._sets([c for c in cs], place)
        m = sets(marks)
        self.marks = (m / np.sqrt(np.maximum(m.sum(1, keepdims=True), 1))).T.copy()
        values, vectors = np.linalg.eigh((self._kernels(m)).astype(np.float64))
        good = values > 1e-6 * values.max()
        root = vectors[:, good] / np.sqrt(values[good])
        phi = self._kernels(sets(c for _, c in samples)).astype(np.float64) @ root
        y = np.array([[1.0 if lang == x else -1.0 for x in self.langs] for lang, _ in samples])
        share = np.array([1.0 / sum(x == lang for x, _ in samples) for lang, _ in samples])[:, None]  # languages weigh alike
        share = share / share.sum()
        centre = (phi * share).sum(0)
        offset = (y * share).sum(0)
        beta = np.linalg.solve((phi - centre).T @ ((phi - centre) * share) + RIDGE * np.eye(phi.shape[1]) / len(samples), (phi - centre).T @ ((y - offset) * share))
        self.weights, self.bias = (root @ beta).astype(np.float32), (offset - centre @ beta).astype(np.float32)

    def table(self) -> np.ndarray:
        """Each code's place among the landmarks' n-grams; the last place is for all others."""
        place = np.full(_ALL, len(self.grams), np.int32)
        place[self.grams] = np.arange(len(self.grams), dtype=np.int32)
        return place

    def _sets(self, many: list[np.ndarray], place: np.ndarray) -> np.ndarray:
        x = np.zeros((len(many), len(self.grams) + 1), np.float32)
        for row, c in zip(x, many):
            row[place[c]] = 1.0
        return x[:, :-1]

    def _kernels(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.marks) / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))

    def predict(self, texts: list[str], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and a score from 0 to 1 for each text."""
        best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for i in range(0, len(texts), ROWS):
            f = self._kernels(self._sets([codes(t) for t in texts[i : i + ROWS]], place)) @ self.weights + self.bias
            e = np.exp(SHARPNESS * (f - f.max(1, keepdims=True)))
            best[i : i + ROWS] = f.argmax(1)
            score[i : i + ROWS] = 1.0 / e.sum(1)
        return best, score


def fit(docs: DataFrame, train: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", seed: int = 10) -> Model:
    """A model of the rows where ``train`` holds, from a bounded sample of them (see the module)."""
    known = docs.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = known.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not counts:
        return Model([])
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    # half as many again as are used, so that a language seldom comes short
    share = F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 1.5 * PER_LANG / r["n"]))]), F.col(lang))

    def start():
        def work(batch: pa.RecordBatch):
            texts = batch.column("__text").to_pylist()
            return [pa.array([np.unique(codes(t)).astype(np.int32).tobytes() if HAS_LETTER.search(t) else None for t in texts], pa.binary())]

        return work

    drawn = known.where(draw < share).select(F.col(lang).alias("lang"), draw.alias("draw"), F.col(text).alias("__text"))
    rows = add_columns(drawn, "codes binary", start).select("lang", "draw", "codes").where("codes is not null").collect()
    used: dict[str, int] = {}
    samples = []
    for r in sorted(rows, key=lambda r: (r["draw"], r["lang"], r["codes"])):
        if used.setdefault(r["lang"], 0) < PER_LANG:
            used[r["lang"]] += 1
            samples.append((r["lang"], np.frombuffer(bytes(r["codes"]), np.int32)))
    return Model(samples)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def start():
        m = Model.__new__(Model)
        vars(m).update(shared.value)
        place = m.table() if m.langs else None

        def work(batch: pa.RecordBatch):
            texts = batch.column(text).to_pylist()
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            at = [i for i, t in enumerate(texts) if m.langs and t and HAS_LETTER.search(t)]
            best, scores = m.predict([texts[i] for i in at], place) if at else ([], [])
            for i, b, s in zip(at, best, scores):
                lang[i], score[i] = m.langs[b], s
            return [pa.array(lang, pa.string()), pa.array(score, pa.float64())]

        return work

    return add_columns(docs, "lang_pred string, score double", start)
