"""Personal data: exact patterns, and a character tagger that finds what they miss.

The base is one pattern and test per kind, leftmost and without retries, so
that, say, a phone number with a card number behind it is one long match that
fails. A BiLSTM-CRF learns the kinds from labelled spans: windows around the
base spans of a bounded sample (``WINDOWS`` windows of about ``SAMPLE`` documents
drawn by seeded hash from the whole table), some spliced from two spans. It reads every text in overlapping
windows. All kinds have a digit or an @, so a window without one is outside by
definition and is not read. Windows are reconciled over the whole text: of
spans that clash, the one farther from its window's edges stays. A span of the
tagger counts if it is a whole value of its kind (same tests, not cut out of a
longer word or number) and no base span overlaps it. Base spans always stay.

Defined results: a null or empty text has no spans; offsets are code points,
the end exclusive; spans are ordered by start, then kind; without labelled
spans in the sample only the base is found; repeated rows are read each.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signals.llm.common import add_columns
from signals.llm.tagger import KINDS, char_ids, decode, tagged, train

WIDTH, STRIDE = 96, 48
#: The tagger is trained on so many labelled windows at most, from about so many documents.
WINDOWS, SAMPLE = 1500, 1500
#: Training windows that one document gives, at most.
EACH = 6
#: Windows decoded at a time.
BATCH = 512

#: Fixed patterns. Possessive and anchored so that each text is read in linear time; the matches are those of the plain forms.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind: str, value: str) -> bool:
    """The test that a match of the kind's pattern has to pass."""
    if kind == "email":
        return True
    if kind == "ip":
        parts = [p.lstrip("0") or "0" for p in value.split(".")]
        return all(len(p) <= 3 and int(p) <= 255 for p in parts)
    n = sum(c in "0123456789" for c in value)
    if kind == "phone":
        return 9 <= n <= 15
    return 12 <= n <= 19 and luhn(value.replace(" ", "").replace("-", ""))


def matches(text: str) -> list[Span]:
    """All matches of the patterns as (start, end, kind), before their tests."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end(), "email"))
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        out += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    return out


def _ordered(spans) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def base_spans(text: str) -> list[Span]:
    return _ordered(s for s in matches(text) if valid(s[2], text[s[0] : s[1]])) if _HINT.search(text) else []


_WHOLE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(?:\.[0-9]+){3}"),
    "card": _CARD,
    "phone": _PHONE,
}


def _is_value(text: str, start: int, end: int, kind: str) -> bool:
    """Is this a whole value of the kind, with no letter or digit right beside it?"""
    value = text[start:end]
    beside = text[start - 1 : start] + text[end : end + 1]
    return bool(_WHOLE[kind].fullmatch(value)) and valid(kind, value) and not any(c.isalnum() for c in beside)


def _windows(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an @."""
    starts: dict[int, None] = {}
    for m in _HINT.finditer(text):
        k = m.start() // STRIDE
        starts.update(dict.fromkeys(max(0, i) * STRIDE for i in (k - 1, k)))
    return sorted(starts)


def tagger_spans(texts: list[str], model: dict) -> list[list[Span]]:
    """The tagger's spans of each text, its windows reconciled."""
    where = [(i, s) for i, t in enumerate(texts) for s in _windows(t)]
    found: list[dict] = [{} for _ in texts]
    for at in range(0, len(where), BATCH):
        part = where[at : at + BATCH]
        ids = np.zeros((len(part), WIDTH), np.int64)
        for row, (i, s) in zip(ids, part):
            c = char_ids(texts[i][s : s + WIDTH])
            row[: len(c)] = c
        for (i, s), tags in zip(part, decode(model, ids)):
            if tags.any():
                last = len(texts[i]) - s
                for kind, a, b in tagged(tags):
                    inner = min(a if s else WIDTH, WIDTH - b if last > WIDTH else WIDTH)  # the text's own ends are no edges
                    span = (s + a, s + min(b, last), KINDS[kind])
                    found[i][span] = max(found[i].get(span, -1), inner)
    out = []
    for spans in found:
        kept: list[Span] = []
        for span in sorted(spans, key=lambda x: (-spans[x], x)):
            if all(span[1] <= k[0] or k[1] <= span[0] for k in kept):
                kept.append(span)
        out.append(kept)
    return out


def all_spans(texts: list[str], model: dict | None) -> list[tuple[list[Span], list[Span]]]:
    """For each text: its base spans, and these with what the tagger adds."""
    base = [base_spans(t) for t in texts]
    more = tagger_spans(texts, model) if model else [[] for _ in texts]
    out = []
    for t, b, m in zip(texts, base, more):
        new = [s for s in m if all(s[1] <= k[0] or k[1] <= s[0] for k in b) and _is_value(t, *s)]
        out.append((b, _ordered([*b, *new])))
    return out


def labelled_windows(text: str, key: int) -> list[tuple[str, list[Span]]]:
    """Training windows of one text: around each base span and around some other digits, with the spans in them."""
    spans = base_spans(text)
    failed = [s for s in matches(text) if s not in spans and sum(c.isdigit() for c in text[s[0] : s[1]]) >= 9]
    r = np.random.default_rng(key & 0x7FFFFFFF)
    hints = [m.start() for m in _HINT.finditer(text)]
    centres = [*spans, *[(hints[i], hints[i] + 1, "") for i in r.integers(0, len(hints), 2 if hints else 0)]]
    out = []
    for i in r.permutation(len(centres))[:EACH]:
        a = centres[i][0]
        start = max(0, a - int(r.integers(4, WIDTH - 30)))
        end = min(len(text), start + WIDTH)
        cut = any(x < start < y or x < end < y for x, y, _ in [*spans, *failed])
        # a match that failed may be several values: no label is known for it
        if not cut and not any(x < end and start < y and not any(s[0] <= x and y <= s[1] for s in spans) for x, y, _ in failed):
            out.append((text[start:end], [(x - start, y - start, k) for x, y, k in spans if start <= x and y <= end]))
    return out


def spliced(windows: list[tuple[str, list[Span]]], seed: int) -> list[tuple[str, list[Span]]]:
    """Windows in which another span follows the first one directly, a space between."""
    r = np.random.default_rng(seed)
    pool = [(w[s[0] : s[1]], s[2]) for w, spans in windows for s in spans]
    out = []
    for w, spans in windows:
        if len(spans) == 1 and pool:
            (a, b, kind), (value, other) = spans[0], pool[int(r.integers(len(pool)))]
            a0 = max(0, a - 20)
            text = w[a0:b] + " " + value + w[b:]
            if b - a0 + 1 + len(value) <= WIDTH:
                out.append((text[:WIDTH], [(a - a0, b - a0, kind), (b - a0 + 1, b - a0 + 1 + len(value), other)]))
    return out


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE, windows: int = WINDOWS, seed: int = 5) -> dict | None:
    """Train the tagger on at most ``windows`` labelled windows of about ``sample`` documents with a hint; None if they have no span."""
    hinted = docs.where(F.col(text).rlike("[0-9@]")).select(F.col(text).alias("__text"), F.xxhash64(F.lit(seed), F.col(doc_id)).alias("key"))
    share = min(1.0, sample / max(1, hinted.count()))

    def start():
        def work(batch: pa.RecordBatch):
            got = [labelled_windows(t, k) for t, k in zip(batch.column("__text").to_pylist(), batch.column("key").to_pylist())]
            packed = [[f"{';'.join(f'{a}:{b}:{k}' for a, b, k in spans)}|{w}" for w, spans in g] for g in got]
            return [pa.array(packed, pa.list_(pa.string()))]

        return work

    drawn = hinted.where(F.pmod("key", F.lit(1 << 40)) < int(share * (1 << 40)))
    rows = add_columns(drawn, "windows array<string>", start).select("key", F.posexplode("windows").alias("at", "w")).collect()
    drawn = sorted(rows, key=lambda r: (r["at"] > 0, r["key"], r["at"], r["w"]))[:windows]  # one window of every document first
    labelled = []
    for r in drawn:
        head, _, w = r["w"].partition("|")
        labelled.append((w, [(int(a), int(b), k) for a, b, k in (x.split(":") for x in head.split(";") if x)]))
    if not any(spans for _, spans in labelled):
        return None
    labelled += spliced(labelled, seed)
    ids, tags = np.zeros((len(labelled), WIDTH), np.int64), np.zeros((len(labelled), WIDTH), np.int64)
    for i, (w, spans) in enumerate(labelled):
        ids[i, : len(w)] = char_ids(w)
        for a, b, kind in spans:
            tag = 1 + 2 * KINDS.index(kind)
            tags[i, a:b], tags[i, a] = tag + 1, tag
    return train(ids, tags, seed=seed)


def find(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """Add ``base`` and ``spans``, arrays of kind:start:end."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        def work(batch: pa.RecordBatch):
            found = all_spans([t or "" for t in batch.column(text).to_pylist()], shared.value)
            return [pa.array([[f"{k}:{a}:{b}" for a, b, k in f[i]] for f in found], pa.list_(pa.string())) for i in (0, 1)]

        return work

    return add_columns(docs, "base array<string>, spans array<string>", start)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind in brackets."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with the spans in ``text`` replaced; a null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def start():
        def work(batch: pa.RecordBatch):
            texts = batch.column(text).to_pylist()
            found = all_spans([t or "" for t in texts], shared.value)
            return [pa.array([t if t is None else masked(t, f[1]) for t, f in zip(texts, found)], pa.string())]

        return work

    return add_columns(docs, f"{text} string", start).select(*columns)
