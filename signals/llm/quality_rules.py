"""Quality rules: a table of thresholds compiled into one Spark projection.

Each rule is a named ratio, a lower and an upper bound. The metrics and the
rules are built-in expressions of the same row: no user function, no shuffle.

Words are runs of characters that aren't white space. ``n_repeat_words`` is
the number of words that lie in a 3-word window which the text holds twice or
more, the first one included. Windows are compared by 64-bit hashes.

Defined results: a null text is an empty one (all counts 0, base failed);
other columns, repeated rows and clashing names pass through untouched because
the metrics are added under the names given in ``METRICS`` and replace columns
of these names; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.llm.common import SPACES, let, words

SYMBOLS = "#*$%&|<>"

#: Function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it was for on be with as by at this an or "
    "le la les de des et un une en que du est dans pour pas qui sur avec au "
    "der die das und den von zu mit sich auf ist im dem nicht ein eine er sch "
    "el los las y por con del se al lo no su para es una"
).split()


class Rule(NamedTuple):
    metric: str
    low: float | None
    high: float | None


#: The verdict's thresholds; a text is kept if every ratio lies in its bounds.
RULES = (
    Rule("n_words", 50, None),
    Rule("mean_word_chars", 2.0, 12.0),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_word_ratio", 0.05, None),
    Rule("dup_line_ratio", None, 0.34),
    Rule("repeat_word_ratio", None, 0.5),
)

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(ws: Column) -> Column:
    """Positions covered by a 3-word window whose key occurs twice or more."""

    def covered(keys: Column) -> Column:
        at = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        same = lambda s, i, j: F.coalesce(F.get(s, j)["k"] == F.get(s, i)["k"], F.lit(False))
        twice = let(at, lambda s: F.filter(s, lambda _, i: same(s, i, i - 1) | same(s, i, i + 1)))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    def of_hashes(h: Column) -> Column:
        keys = F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))
        return F.when(
            F.size(h) >= 4,
            let(keys, lambda k: F.when(F.size(F.array_distinct(k)) < F.size(k), covered(k)).otherwise(0)),
        ).otherwise(0)

    return let(F.transform(ws, lambda w: F.xxhash64(w)), of_hashes).cast("long")


def metrics(text: Column) -> Column:
    """A struct of the counts in ``METRICS`` and ``n_lines``, ``n_stop_words`` of one text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    # stop words: lower case, closing punctuation off, looked up in a fixed list

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.char_length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
            (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(ws).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(ws, lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        )

    return let(words(text), of_words)


def _ratio(name: str, m: Column) -> Column:
    per = lambda a, b: F.when(m[b] > 0, m[a] / m[b]).otherwise(0.0)
    ratios = {
        "mean_word_chars": ("word_chars", "n_words"),
        "symbol_ratio": ("n_symbols", "n_words"),
        "stop_word_ratio": ("n_stop_words", "n_words"),
        "dup_line_ratio": ("n_dup_lines", "n_lines"),
        "repeat_word_ratio": ("n_repeat_words", "n_words"),
    }
    return per(*ratios[name]) if name in ratios else m[name].cast("double")


def verdict(m: Column, rules=RULES) -> Column:
    """True if every rule's ratio is within its bounds."""
    tests = [F.lit(True)]
    for r in rules:
        v = _ratio(r.metric, m)
        tests += [v >= F.lit(float(r.low))] if r.low is not None else []
        tests += [v <= F.lit(float(r.high))] if r.high is not None else []
    return reduce(lambda a, b: a & b, tests)


def apply_rules(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Add the metrics, ``base_failed`` and ``kept`` to every row of ``docs``."""
    m = F.col("__m")
    base = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    added = {x: m[x] for x in METRICS} | {"base_failed": base, "kept": ~base & verdict(m, rules)}
    keep = [c for c in docs.columns if c not in added]
    return docs.withColumn("__m", metrics(F.col(text))).select(*keep, *[c.alias(k) for k, c in added.items()])


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs`` only."""
    m = F.col("__m")
    base = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    return docs.withColumn("__m", metrics(F.col(text))).where(~base & verdict(m, rules)).drop("__m")
