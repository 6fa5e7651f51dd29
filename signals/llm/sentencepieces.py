"""SentencePiece BPE encoding by a prefix table, and decoding.

A BPE encoding is determined by its last token: every prefix of a text has
exactly one token that its encoding ends with. Reading a text left to right,
an automaton gives the pieces that end at each character; the one that fits is
the one whose pair with the last token of the prefix before it is compatible
(the pair's own text encodes to just these two tokens). The ids are recovered
backwards from the table, in time linear in the text.

No piece of such a vocabulary has a space inside or a line break (checked when
it is loaded), so a text is cut before its space runs, around line breaks, and
between a letter and a punctuation mark that follows a letter in no piece.
Each distinct unit is encoded once per worker and kept in a bounded memo.
A run of spaces has pieces of equal, lowest scores; the run that is left once
its last space has merged into the word is merged by itself, leftmost first.

Defined results: a null or empty text has no ids and decodes to an empty text;
characters outside the vocabulary become byte tokens (the unknown id if the
vocabulary has none); repeated rows are encoded each; other columns pass
through, columns named as the result are replaced; an empty table gives an
empty result. The vocabulary (bounded: its file) is broadcast as rows, so only
the driver needs the file.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from signals.llm.common import add_columns

SPACE = "▁"
LETTER = re.compile(r"[^\W\d_]")
PUNCTUATION = ".,;:!?|%$#&*"
#: Entries of a worker's memo of units; it is emptied when full.
MEMO = 400_000
#: Longer units are not kept in the memo.
MEMO_CHARS = 48


def read_vocabulary(path: str) -> dict:
    """The pieces of a model file: normal ones with scores, byte tokens, the unknown id, and what each id decodes to."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, byte_ids, text_of = {}, {}, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            text_of.append("")
        elif sp.is_unknown(i):
            text_of.append(" ⁇ ")
        elif sp.is_control(i):
            text_of.append("")
        else:
            text_of.append(piece.replace(SPACE, " "))
            if not sp.is_unused(i):
                scores[piece] = (sp.get_score(i), i)
    across = [p for p in scores if "\n" in p or SPACE in p.lstrip(SPACE) or (p[:2] == SPACE * 2 and p.strip(SPACE))]
    if across:
        raise ValueError(f"pieces across words or lines: {across[:5]}")
    return {"scores": scores, "bytes": byte_ids, "unk": sp.unk_id(), "text_of": text_of}


def merge(symbols: list[str], scores: dict) -> list[str]:
    """Plain BPE: merge the adjacent pair of the highest score, leftmost first, until none is left."""
    n = len(symbols)
    sym, left, right = list(symbols), [i - 1 for i in range(n)], [i + 1 for i in range(n)]
    heap: list = []

    def offer(i: int) -> None:
        if i >= 0 and right[i] < n and (s := scores.get(joined := sym[i] + sym[right[i]])):
            heapq.heappush(heap, (-s[0], i, joined))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, joined = heapq.heappop(heap)
        if not sym[i] or right[i] >= n or sym[i] + sym[right[i]] != joined:
            continue
        j = right[i]
        sym[i], sym[j], right[i] = joined, "", right[j]
        if right[j] < n:
            left[right[j]] = i
        offer(left[i])
        offer(i)
    return [s for s in sym if s]


class Encoder:
    """The prefix table of one vocabulary; its memos live as long as a Python worker."""

    def __init__(self, vocabulary: dict):
        import ahocorasick

        self.scores, self.bytes, self.unk = vocabulary["scores"], vocabulary["bytes"], vocabulary["unk"]
        self.pair, self.memo = {}, {}
        self.piece = {i: p for p, (_, i) in self.scores.items()}
        inside = {p[i] for p in self.scores for i in range(1, len(p)) if LETTER.match(p[i - 1])}
        cut = "".join(re.escape(c) for c in PUNCTUATION if c not in inside) or "\\n"
        body = f"[^{SPACE}\\n](?:[^{SPACE}\\n{cut}]|(?<![^\\W\\d_])[{cut}])*"
        self.units = re.compile(f"{SPACE}+(?:{body})?|{body}|\\n").findall
        self.automaton = ahocorasick.Automaton()
        for piece, (_, i) in self.scores.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()

    def compatible(self, a: int, b: int) -> bool:
        """Does the text of two tokens encode to just these two? ``a`` is -1 at a unit's start and after a foreign character."""
        parts = [self.piece[b]] if a < 0 else [self.piece[a], self.piece[b]]
        if len(self.pair) > MEMO:
            self.pair.clear()
        ok = self.pair[a << 20 | b] = merge(list("".join(parts)), self.scores) == parts
        return ok

    def foreign(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode("utf-8")] if self.bytes else [self.unk]

    def prefix_table(self, unit: str) -> list[int]:
        """Ids of a unit with at most one space mark, at its start."""
        n = len(unit)
        last = [-1] * (n + 1)  # of each prefix: the last token of its encoding; -1 for a foreign character
        known, done = self.pair.get, -1
        for end, (token, length) in self.automaton.iter(unit):  # the longest piece at each end comes first
            if end != done:
                before = last[end + 1 - length]
                ok = known(before << 20 | token)
                if self.compatible(before, token) if ok is None else ok:
                    last[end + 1], done = token, end
        ids: list[int] = []
        while n:
            token = last[n]
            if token < 0:
                ids.extend(reversed(self.foreign(unit[n - 1])))
                n -= 1
            else:
                ids.append(token)
                n -= len(self.piece[token])
        ids.reverse()
        return ids

    def spaces(self, n: int) -> list[int]:
        return [self.scores[p][1] for p in merge([SPACE] * n, self.scores)]

    def unit_ids(self, unit: str) -> list[int]:
        run = len(unit) - len(unit.lstrip(SPACE))
        if run == len(unit):
            return self.spaces(run)
        if run < 2:
            return self.prefix_table(unit)
        ids = self.prefix_table(unit[run - 1 :])
        lone = ids[0] == self.scores[SPACE][1]
        return self.spaces(run - (not lone)) + ids[lone:]

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as packed int32."""
        if not text:
            return b""
        memo, out = self.memo, []
        for unit in self.units(SPACE + text.replace(" ", SPACE)):
            ids = memo.get(unit)
            if ids is None:
                ids = np.array(self.unit_ids(unit), np.int32).tobytes()
                if len(unit) <= MEMO_CHARS:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[unit] = ids
            out.append(ids)
        return b"".join(out)


class Decoder:
    def __init__(self, vocabulary: dict):
        self.text_of, self.byte_of = list(vocabulary["text_of"]), {i: b for b, i in vocabulary["bytes"].items()}
        for i, b in self.byte_of.items():
            if b < 128:
                self.text_of[i] = chr(b)
        #: A text's first space mark is the encoder's own.
        self.marked = {i for i, t in enumerate(self.text_of) if t[:1] == " " and i not in self.byte_of and i != vocabulary["unk"]}
        high = [i for i, b in self.byte_of.items() if b >= 128]
        self.low, self.high = min(high, default=0), max(high, default=-1)

    def bytes_text(self, run: bytes) -> str:
        """UTF-8 of a run of byte tokens; a byte that starts no character becomes U+FFFD."""
        out = []
        while run:
            try:
                return "".join(out) + run.decode("utf-8")
            except UnicodeDecodeError as e:
                out.append(run[: e.start].decode("utf-8") + "�")
                run = run[e.start + 1 :]
        return "".join(out)

    def decode(self, ids: np.ndarray) -> str:
        if not ((ids >= self.low) & (ids <= self.high)).any():
            text = "".join(map(self.text_of.__getitem__, ids.tolist()))
        else:
            out, run = [], []
            for i in [*ids.tolist(), -1]:
                if i in self.byte_of:
                    run.append(self.byte_of[i])
                    continue
                if run:
                    out.append(self.bytes_text(bytes(run)))
                    run = []
                if i >= 0:
                    out.append(self.text_of[i])
            text = "".join(out)
        return text[1:] if len(ids) and int(ids[0]) in self.marked else text


def _ids(encoder: Encoder, texts: pa.Array) -> pa.ListArray:
    packed = [encoder.encode(t.as_py()) for t in texts]
    ends = np.cumsum([0, *map(len, packed)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _texts(decoder: Decoder, ids: pa.ListArray) -> pa.Array:
    return pa.array([decoder.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else "" for x in ids], pa.string())


def _live(known: dict, name: str, make):
    """``make(known)``, once for all tasks of a Python worker, which share the broadcast value: the memos live on."""
    known[name] = known.get(name) or make(known)
    return known[name]


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of ``text`` under the model at ``path``, without begin or end ids."""
    vocabulary = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def start():
        encoder = _live(vocabulary.value, "encoder", Encoder)
        return lambda batch: [_ids(encoder, batch.column(text))]

    return add_columns(df, f"{ids} array<int>", start)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that ``ids`` stand for; null ids give an empty text."""
    vocabulary = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def start():
        decoder = _live(vocabulary.value, "decoder", Decoder)
        return lambda batch: [_texts(decoder, batch.column(ids))]

    return add_columns(df, f"{text} string", start)


def encode_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``decode(encode(df))`` in one pass of one Python worker."""
    vocabulary = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def start():
        encoder, decoder = _live(vocabulary.value, "encoder", Encoder), _live(vocabulary.value, "decoder", Decoder)

        def work(batch: pa.RecordBatch):
            coded = _ids(encoder, batch.column(text))
            return [coded, _texts(decoder, coded)]

        return work

    return add_columns(df, f"{ids} array<int>, {decoded} string", start)
