"""Toxicity by a weighted finite-state grammar of clauses.

A text's words are read as classes (insult, threat, target, negation, verb of
saying, quotation mark, end of a clause); the composed transducers of
``transducers`` turn them into matches of eight kinds, by what stands around
the insult or threat in its clause. A match counts with the weight of its word;
the kinds' sums, as logarithms, enter a logistic score.

What is learned, from at most ``TOXIC`` and ``CLEAN`` labelled rows drawn by
seeded hash over the whole label table: the marks of toxic texts, which are
words or beginnings of words, in any language. A mark hardly occurs in clean
texts and stands in several surroundings (so that what copies of one text share
is no mark); marks are taken as long as they are found in toxic texts that have
few marks yet. The kinds' weights come from a ridge regression towards the
grammar's own weights, which hold where there are no labels. The driver gets
the drawn rows' eight sums, ``CANDIDATES`` words and their places. All rows are
scored, over whole texts.

Defined results: a null text counts as empty; a text without a match gets the
score of the bias alone; a label row with a null id, a null label or an id that
no document has is not used; an id with several labels counts as toxic if one
of them says so, an id with several texts by its least one; repeated rows are
scored alike; an empty table gives an empty result; other columns may have any
name, but for ``score`` and ``predicted``, which are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.llm.common import add_columns, stored
from signals.llm.transducers import END, INSULT, KINDS, NEGATION, OTHER, QUOTE, REPORT, SYMBOLS, TARGET, THREAT, grammar

TOXIC, CLEAN = 2000, 4000  # labelled rows that the fit may use
CANDIDATES = 3000
MARKS = 200  # learned at most
STEMS = range(3, 9)  # characters of a word's beginning
SHARE = 0.8  # of a mark's texts that are toxic, at equal numbers of toxic and clean texts
MARKS_OF_A_TEXT = 5  # wanted
LEAST, NEW = 3, 0.01  # toxic texts that a mark is in; share of them that had no mark before it
#: Log-likelihood ratio (G2) that a mark needs: if it adds texts without marks, if it doesn't.
CERTAIN, VERY_CERTAIN = 10.0, 40.0
SURROUNDINGS = 4  # different words before a mark
COST = 3.0  # of a clean text with the mark, at equal numbers, against a toxic one
FULL = 6.0  # log odds at which a mark has the weight 1
RIDGE = 0.05

#: Word lists of the grammar, lower case, without apostrophes.
INSULTS = "idiot idiots moron morons stupid scum trash loser losers worthless pathetic disgusting imbecile dumbass bastard vermin idiota imbécil estúpido idioten abschaum dummkopf imbécile crétin ordure".split()
THREATS = "kill murder shoot stab strangle behead lynch hang burn töten umbringen matar tuer".split()
TARGETS = "you your youre yourself u he hes she shes they them theyre these those him her people everyone du dich ihr euch sie tu te vous usted ustedes toi".split()
NEGATIONS = "not no never neither nor cannot without isnt arent wasnt werent dont doesnt didnt wont wouldnt couldnt shouldnt nicht kein keine nie pas jamais nunca".split()
REPORTS = "said says say saying called calls calling wrote writes writing claimed claims quoted quotes shouted shouts yelled tweeted alleged reported reportedly sagte schrieb dit écrit dijo escribió".split()
#: The grammar's own weights: bias, then one for each of KINDS.
PRIOR = np.array([-4.0, 5.0, 7.0, 1.0, 1.0, 2.0, 7.0, 0.5, 1.0])

_END, _QUOTE = b"\x01", b"\x02"
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 1 if chr(c) in ".!?;\n" else 2 if c == 34 else 32 for c in range(256))
_QUOTES = [q.encode() for q in "“”„«»"]
_APOSTROPHE = "’".encode()
_FAR = 8  # words without a class beyond this change nothing more


def words_of(text: bytes) -> list[bytes]:
    """The words of a lower-case text (apostrophes dropped), marks of clause ends and of quotation."""
    if b"\xe2\x80" in text or b"\xc2" in text:
        for q in _QUOTES:
            text = text.replace(q, b'"')
        text = text.replace(_APOSTROPHE, b"")
    return text.translate(_TABLE, b"'").replace(_END, b" \x01 ").replace(_QUOTE, b" \x02 ").split()


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


class Model:
    """Words of each class and beginnings of insults with their weights, the composed table, and the kinds' weights."""

    def __init__(self, weights: np.ndarray, marks: dict[str, float]):
        """``marks``: weight of each learned beginning of words, or whole word with a ``$`` behind it."""
        self.weights = weights
        number = {x: n for n, x in enumerate(SYMBOLS)}
        self.classes = {_END: (number[END], 0.0), _QUOTE: (number[QUOTE], 0.0)}
        for name, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS), (INSULT, INSULTS)):
            self.classes |= {w.encode(): (number[name], 1.0) for w in words}
        self.stems = {m.encode(): w for m, w in marks.items() if m[-1] != "$"}
        self.classes |= {m[:-1].encode(): (number[THREAT if m[:-1] in THREATS else INSULT], w) for m, w in marks.items() if m[-1] == "$"}
        self.sizes = sorted({len(m) for m in self.stems})
        core = [w for w, (x, weight) in self.classes.items() if x in (number[INSULT], number[THREAT]) and weight > 0]
        self.heads = {w[:3] for w in [*core, *self.stems]}
        kind = {k: n for n, k in enumerate(KINDS)}
        self.table = [[(after, tuple(kind[k] for k in out if k in kind)) for after, out in row] for row in grammar().table()]
        self.other, self.end, self.insult, self.threat = (number[x] for x in (OTHER, END, INSULT, THREAT))

    def class_of(self, word: bytes) -> tuple[int, float] | None:
        found = self.classes.get(word)
        if found is None and word[:3] in self.heads:
            weights = [self.stems[word[:n]] for n in self.sizes if word[:n] in self.stems]
            return (self.insult, max(weights)) if weights else None
        return found

    def sums(self, text: bytes) -> np.ndarray | None:
        """The kinds' sums over the clauses of a lower-case text; None if no word begins like an insult or threat."""
        words = words_of(text)
        different = set(words)
        if self.heads.isdisjoint({w[:3] for w in different}):
            return None
        known = {w: x for w in different if (x := self.class_of(w))}
        half = len(KINDS) // 2
        total = [0.0] * len(KINDS)
        waiting: tuple[list, list] = ([], [])  # weights of insults and of threats not written yet, in order
        state, last = 0, -1
        hits = [(n, known[w]) for n, w in enumerate(words) if w in known]
        for n, (x, weight) in [*hits, (len(words), (self.end, 0.0))]:
            steps = [self.other] * min(n - last - 1, _FAR) + [x]
            last = n
            if x == self.insult or x == self.threat:
                waiting[x == self.threat].append(weight)
            for y in steps:
                state, wrote = self.table[state][y]
                for k in wrote:
                    total[k] += waiting[k >= half].pop(0)
        return np.array(total)

    def score(self, sums: np.ndarray | None) -> float:
        z = self.weights[0] + (0.0 if sums is None else float(np.log1p(sums) @ self.weights[1:]))
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


def regression(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = RIDGE, prior: np.ndarray = PRIOR) -> np.ndarray:
    """Logistic weights (bias first) of rows with the given shares, drawn towards ``prior``."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, eye = prior.copy(), ridge * np.eye(x.shape[1])
    loss = lambda w: float(share @ np.logaddexp(0, np.where(y == 1, -1, 1) * (x @ w)) + ridge / 2 * ((w - prior) ** 2).sum())
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (share * (p - y)) + ridge * (w - prior)
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + eye, slope)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if size * np.abs(step).max() < 1e-8:
            break
    return w


def _sample(docs: DataFrame, labels: DataFrame, train: Column, seed: int) -> DataFrame:
    """(toxic, text, share) of the drawn rows; share: how many labelled rows each stands for."""
    label = F.col("toxic").cast("int")
    own = labels.select("doc_id", label.alias("toxic")).where(train & F.col("doc_id").isNotNull() & label.isNotNull())
    own = own.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    count = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = {t: min(1.0, most / max(count.get(t, 0), 1)) for t, most in ((1, TOXIC), (0, CLEAN))}
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = own.where(draw < F.when(F.col("toxic") == 1, rate[1]).otherwise(rate[0]))
    # about TOXIC + CLEAN ids; a few deviations of the draw more is what the broadcast can hold
    drawn = drawn.limit(TOXIC + CLEAN + 1000)
    of_id = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = of_id.groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    share = F.when(F.col("toxic") == 1, 1 / rate[1]).otherwise(1 / rate[0])
    return stored(rows.select("toxic", "text", share.alias("share")), "toxic-sample")


def _candidates_of(words: list[bytes]) -> dict[str, list]:
    """A text's possible marks: how often each occurs, and a bit mask of hashed words before it."""
    found: dict[str, list] = {}
    seen: dict[tuple, int] = {}
    for pair in zip([b"", *words], words):
        seen[pair] = seen.get(pair, 0) + 1
    for (before, w), n in seen.items():
        word, bit = w.decode("utf-8", "replace"), 1 << (zlib.crc32(before) % 63)
        if len(word) < STEMS[0] or len(word) > 60:
            continue
        for mark in (word + "$", *(word[:k] for k in STEMS if k <= len(word))):
            entry = found.setdefault(mark, [0, 0])
            entry[0] += n
            entry[1] |= bit
    return found


def _learned(sample: DataFrame) -> dict[str, float]:
    """The marks of toxic texts with their weights; also words of the lists that the sample speaks on."""
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return {}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):  # bounds the table of a batch
                batch = whole.slice(at, 64)
                table: dict[str, list] = {}
                for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for mark, (n, mask) in _candidates_of(words_of(lowered(text))).items():
                        entry = table.setdefault(mark, [0, 0, 0, 0])
                        if toxic:
                            entry[0], entry[2], entry[3] = entry[0] + 1, entry[2] + n, entry[3] | mask
                        else:
                            entry[1] += 1
                columns = list(zip(*table.values())) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(list(table), pa.string()), *(pa.array(c, pa.int64()) for c in columns)], names=["mark", "bad", "good", "n", "mask"])

    counts = sample.select("toxic", "text").mapInArrow(count, "mark string, bad bigint, good bigint, n bigint, mask bigint")
    found = counts.groupBy("mark").agg(*(F.sum(c).alias(c) for c in ("bad", "good", "n")), F.bit_or("mask").alias("mask"))
    rates = F.col("bad") / size[1], (F.col("good") + 0.5) / size[0]
    term = lambda seen, rows, of: seen * F.log(F.greatest(seen, F.lit(1e-9)) * F.lit(size[0] + size[1]) / (F.lit(rows) * of))
    both, neither = F.col("bad") + F.col("good"), size[0] + size[1] - F.col("bad") - F.col("good")
    ratio = term(F.col("bad"), size[1], both) + term(F.col("good"), size[0], both) + term(size[1] - F.col("bad"), size[1], neither) + term(size[0] - F.col("good"), size[0], neither)
    found = found.withColumns({"share": rates[0] / (rates[0] + rates[1]), "around": F.bit_count("mask"), "certain": F.when(neither > 0, 2 * ratio).otherwise(0.0)})
    others = [w + "$" for w in (*TARGETS, *NEGATIONS, *REPORTS)]
    marks = (F.col("bad") >= LEAST) & (F.col("share") >= SHARE) & (F.col("around") >= SURROUNDINGS) & (F.col("certain") >= CERTAIN) & ~F.col("mark").isin(others)
    listed = F.col("mark").isin([w + "$" for w in (*INSULTS, *THREATS)]) & (F.col("bad") + F.col("good") >= 2 * LEAST)
    found = found.where(marks | listed).withColumn("listed", listed).orderBy(F.desc("listed"), F.desc("certain"), F.desc("n"), "mark").limit(CANDIDATES)
    rows = found.select("mark", "n", "share", "certain", "listed", (rates[1] * size[1]).alias("cost")).collect()
    weight = {r["mark"]: max(0.0, min(1.0, math.log(max(r["share"], 1e-9) / (1 - r["share"])) / FULL)) for r in rows}
    chosen = {r["mark"]: weight[r["mark"]] for r in rows if r["listed"]}
    candidates = [r for r in rows if not r["listed"]]
    place = {r["mark"]: n for n, r in enumerate(candidates)}
    shared = sample.sparkSession.sparkContext.broadcast(place)

    def locate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        for batch in batches:
            at = [sorted(place[m] for m in _candidates_of(words_of(lowered(t))) if m in place) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.list_(pa.int32()))], names=["at"])

    held = sample.where("toxic = 1").select("text").mapInArrow(locate, "at array<int>").collect()
    shared.unpersist()
    texts: list[list[int]] = [[] for _ in candidates]
    for t, at in enumerate(sorted(r["at"] for r in held)):
        for c in at:
            texts[c].append(t)
    for c in _covering(candidates, [np.array(t, np.int64) for t in texts], len(held)):
        chosen[candidates[c]["mark"]] = weight[candidates[c]["mark"]]
    return chosen


def _covering(candidates: list, texts: list[np.ndarray], n_texts: int) -> list[int]:
    """Candidates taken one by one, each the one worth most.

    Worth is the number of toxic texts with fewer marks than are wanted, less
    ``COST`` for clean ones. Of those worth as much, the one with more
    occurrences, then the longer one wins: the beginning that all forms of a
    word share. What begins with a mark, or what a mark begins with, is not
    taken after it.
    """
    marks = np.zeros(n_texts, np.int64)
    left, taken = set(range(len(candidates))), []
    while left and len(taken) < MARKS:
        gain = {c: int((marks[texts[c]] < MARKS_OF_A_TEXT).sum()) for c in left}
        left = {c for c in left if gain[c]}
        new = {c: int((marks[texts[c]] == 0).sum()) for c in left}
        fit_for = [c for c in left if new[c] >= max(2, NEW * n_texts) or candidates[c]["certain"] >= VERY_CERTAIN and 2 * gain[c] >= len(texts[c])]
        if not fit_for:
            break
        worth = lambda c: gain[c] - COST * candidates[c]["cost"]
        best = max(fit_for, key=lambda c: (round(worth(c)), candidates[c]["n"], len(candidates[c]["mark"]), candidates[c]["mark"]))
        taken.append(best)
        marks[texts[best]] += 1
        mark = candidates[best]["mark"].rstrip("$")
        left = {c for c in left if not (other := candidates[c]["mark"].rstrip("$")).startswith(mark) and not mark.startswith(other)}
    return taken


def fit(docs: DataFrame, labels: DataFrame, train: Column, seed: int = 13) -> Model:
    """A model of ``documents`` (doc_id, text) and ``labels`` (doc_id, toxic) where ``train``, a condition on doc_id, holds."""
    sample = _sample(docs, labels, train, seed)
    learned = _learned(sample)
    plain = Model(PRIOR, learned)
    shared = docs.sparkSession.sparkContext.broadcast(vars(plain))

    def start():
        model = Model.__new__(Model)
        vars(model).update(shared.value)

        def work(batch: pa.RecordBatch):
            sums = [model.sums(lowered(t)) for t in batch.column("text").to_pylist()]
            return [pa.array([np.zeros(len(KINDS)) if s is None else s for s in sums], pa.list_(pa.float64()))]

        return work

    rows = add_columns(sample, "sums array<double>", start).groupBy("toxic", "sums").agg(F.sum("share").alias("share")).collect()
    shared.unpersist()
    if len({r["toxic"] for r in rows}) < 2:
        return plain
    rows.sort(key=lambda r: (r["toxic"], r["sums"]))
    x, y = np.log1p(np.array([r["sums"] for r in rows])), np.array([r["toxic"] for r in rows])
    return Model(regression(x, y, np.array([r["share"] for r in rows])), learned)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def start():
        own = Model.__new__(Model)
        vars(own).update(shared.value)
        plain = own.score(None)

        def work(batch: pa.RecordBatch):
            sums = (own.sums(lowered(t)) for t in batch.column(text).to_pylist())
            score = np.array([plain if s is None else own.score(s) for s in sums])
            return [pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))]

        return work

    return add_columns(docs, "score double, predicted int", start)
