"""Grep filter and grep routing over raw lines or whole documents.

All patterns are evaluated in one projection. Patterns without regex
metacharacters use ``contains`` (a byte search, no regex engine). A regex
with a required literal (e.g. '@' in an e-mail pattern) is guarded by a
``contains`` of it, so texts without it skip the regex; for mode ``any``
the remaining regexes without groups are folded into one alternation (groups
would change their numbers there). Regexes mean what they mean in Python.

More than ``MANY`` literals are one regex that shares their beginnings (a trie),
so that a text is read once, not once for each. Routes read from such a scan
which literals occurred, at every position of the text: the longest one there,
which tells the others, since they are its beginnings.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.operators.parse import python_semantics, to_java_regex

_META = re.compile(r"[\\.^$|?*+()\[\]{}]")

MODES = ("any", "all", "none")
#: Literals beyond which one scan for all is cheaper than a byte search for each.
MANY = 16


def is_literal(pattern: str) -> bool:
    return not _META.search(pattern)


def required_literal(pattern: str) -> str | None:
    """The longest literal run every match of ``pattern`` must contain, if any.

    Only top-level literals count (not inside repeats, alternations or
    optional groups); case-insensitive patterns have none.
    """
    try:
        from re import _parser as sre_parse
    except ImportError:  # pragma: no cover
        import sre_parse  # type: ignore
    try:
        tree = sre_parse.parse(pattern)
    except re.error:
        return None
    if tree.state.flags & re.IGNORECASE:
        return None
    best, run = "", []
    for op, av in list(tree) + [(None, None)]:
        if str(op) == "LITERAL":
            run.append(chr(av))
            continue
        cur = "".join(run)
        if len(cur) > len(best):
            best = cur
        run = []
    return best or None


def trie_pattern(literals: Sequence[str]) -> str:
    """A Java regex for the longest of ``literals`` at a place, with common beginnings written once."""
    words = sorted(set(literals))

    def node(lo: int, hi: int, at: int) -> str:
        """The rests, from ``at`` on, of words[lo:hi], which are equal before it."""
        ends = len(words[lo]) == at
        lo += ends
        branches = []
        while lo < hi:
            to = lo
            while to < hi and words[to][at] == words[lo][at]:
                to += 1
            # sorted words share what the first and the last of them share
            end = at + 1
            while end < len(words[lo]) and end < len(words[to - 1]) and words[lo][end] == words[to - 1][end]:
                end += 1
            branches.append(_escaped(words[lo][at:end]) + node(lo, to, end))
            lo = to
        if not branches:
            return ""
        inner = branches[0] if len(branches) == 1 and not ends else "(?:" + "|".join(branches) + ")"
        return inner + "?" if ends else inner

    return node(0, len(words), 0)


def _escaped(text: str) -> str:
    return "".join("\\" + x if _META.match(x) else x for x in text)


def _java(pattern: str) -> str:
    return python_semantics(to_java_regex(pattern))


def _match(c: Column, pattern: str, fixed: bool) -> Column:
    if fixed or is_literal(pattern):
        return c.contains(pattern)
    lit = required_literal(pattern)
    m = c.rlike(_java(pattern))
    # A byte search first: most texts lack the literal and never reach the regex engine.
    return (c.contains(lit) & m) if lit else m


def grep_match(c: Column | str, patterns: Sequence[str], mode: str = "any", fixed: bool = False) -> Column:
    """Boolean column: does the text match any / all / none of ``patterns``."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if not patterns:
        raise ValueError("at least one pattern is required")
    col = F.col(c) if isinstance(c, str) else c
    if mode in ("any", "none"):
        lits = [p for p in patterns if fixed or is_literal(p)]
        regs = [p for p in patterns if not (fixed or is_literal(p))]
        parts = [col.contains(p) for p in lits] if len(lits) <= MANY or "" in lits else [col.rlike(trie_pattern(lits))]
        guarded = [p for p in regs if required_literal(p)]
        free = [p for p in regs if not required_literal(p)]
        own = [p for p in free if re.compile(p).groups]
        free = [p for p in free if p not in own]
        parts += [_match(col, p, False) for p in [*guarded, *own]]
        if free:
            # patterns without a required literal share one alternation: one regex scan per text
            parts.append(col.rlike("|".join(f"(?:{_java(p)})" for p in free)))
        hit = reduce(lambda a, b: a | b, parts)
        hit = F.coalesce(hit, F.lit(False))
        return ~hit if mode == "none" else hit
    hit = reduce(lambda a, b: a & b, [_match(col, p, fixed) for p in patterns])
    return F.coalesce(hit, F.lit(False))


def grep(
    df: DataFrame,
    patterns: Sequence[str],
    col: str = "raw_data",
    mode: str = "any",
    invert: bool = False,
    fixed: bool = False,
) -> DataFrame:
    """Keep rows whose ``col`` matches any / all / none of ``patterns`` (F11); ``invert`` flips it.

    Works on batch and streaming DataFrames. Null text never matches.
    """
    m = grep_match(col, patterns, mode, fixed)
    return df.filter(~m if invert else m)


def route(
    df: DataFrame,
    routes: Mapping[str, str | Sequence[str]],
    col: str = "raw_data",
    default: str = "default",
    route_col: str = "route",
) -> DataFrame:
    """One output row per (line, matching route); lines matching none go to ``default``.

    A route is a pattern or a list of patterns (matched with mode ``any``).
    """
    if not routes:
        raise ValueError("at least one route is required")
    lists = {name: [p] if isinstance(p, str) else list(p) for name, p in routes.items()}
    plain = {name: p for name, p in lists.items() if all(is_literal(x) and x for x in p)}
    literals = sorted({x for p in plain.values() for x in p})
    if len(literals) <= MANY:
        plain, found = {}, None
    else:
        tmp = "__found"
        df = df.withColumn(tmp, F.array_distinct(F.regexp_extract_all(F.col(col), F.lit(f"(?=({trie_pattern(literals)}))"), F.lit(1))))
        found = F.col(tmp)

    def hit(name: str, patterns: list[str]) -> Column:
        if name not in plain:
            return grep_match(col, patterns)
        told = [x for x in literals if any(x.startswith(p) for p in patterns)]
        return F.arrays_overlap(found, F.array(*[F.lit(x) for x in told]))

    hits = F.array_compact(F.array(*[F.when(hit(name, p), F.lit(name)) for name, p in lists.items()]))
    names = F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(default)))
    return df.withColumn(route_col, F.explode(names)).drop("__found")


def write_routes(routed: DataFrame, path: str, route_col: str = "route", fmt: str = "parquet", mode: str = "append") -> None:
    """Sink partitioned by route, so each route's readers prune to their folder.

    The REBALANCE hint lets adaptive execution split a busy route over
    several writers and merge quiet ones (few right-sized files per folder).
    """
    routed.hint("rebalance", route_col).write.mode(mode).partitionBy(route_col).format(fmt).save(path)


def stream_routes(routed: DataFrame, path: str, checkpoint: str, route_col: str = "route", fmt: str = "parquet"):
    """Start a streaming sink partitioned by route (F12 on a stream); returns the query."""
    return (
        routed.writeStream.format(fmt).partitionBy(route_col)
        .option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start()
    )
