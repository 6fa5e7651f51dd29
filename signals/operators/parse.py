"""Parsing and typing.

A parse rule is validated once on the driver and compiled into native column
expressions; no per-row Python runs. ``normalize`` is the user-level call: it
adds ``parsed`` (MAP<STRING,STRING>) and ``parse_status`` to a log table or
stream, and ``split_quarantine`` separates the error rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.functions.text import PY_WHITESPACE, literal_split, strip_chars

MAP_TYPE = "map<string,string>"

PARSED = "parsed"
EMPTY = "empty"
ERROR = "error"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _empty_map() -> Column:
    return F.create_map().cast(MAP_TYPE)


def _null_map() -> Column:
    return F.lit(None).cast(MAP_TYPE)


# ---------------------------------------------------------------- C1 / C2 key-value


def kv_parse(
    c: Column | str,
    separator: str = "=",
    delimiter: str | None = " ",
    drop_empty_keys: bool = False,
    whitespace: str = PY_WHITESPACE,
    first_seen_order: bool = False,
) -> Column:
    """Key-value parse of a string column into MAP<STRING,STRING> (C1; C2 with ``drop_empty_keys``).

    Split on the literal ``delimiter``, keep fragments containing ``separator``,
    split each at its first separator, strip both sides, and let the last
    duplicate key win. An empty key is kept unless ``drop_empty_keys``.

    Duplicates are resolved without a session setting: entries are sorted by
    (key, position) and an entry is kept when the next one has another key,
    i.e. the last occurrence of each key survives. O(n log n) per line.
    Keys in the resulting map are in key order; with ``first_seen_order``
    they are in order of first appearance, as a Python dict or JS object
    built by assignment keeps them (for previews; about twice the cost).
    """
    if not isinstance(separator, str) or not isinstance(delimiter, (str, type(None))):
        raise ValueError("the separator must be a string, the delimiter a string or null")
    if separator == "" or delimiter == "":
        raise ValueError("empty separator")
    n = len(separator)
    if delimiter is None:  # any run of white space, as Python's split() without an argument
        spaces = "[" + "".join(f"\\x{{{ord(x):x}}}" for x in PY_WHITESPACE) + "]+"
        pieces = F.split(_col(c), spaces)
    else:
        pieces = literal_split(_col(c), delimiter)
    frags = F.filter(pieces, lambda p: F.instr(p, separator) > 0)
    entries = F.transform(
        frags,
        lambda p, i: F.struct(
            strip_chars(F.substring_index(p, separator, 1), whitespace).alias("k"),
            i.alias("i"),
            strip_chars(F.substr(p, F.instr(p, separator) + F.lit(n)), whitespace).alias("v"),
        ),
    )
    # The sorted array is bound once through a one-element array's lambda, so it is
    # computed once per row although the dedupe step reads it three times.
    kept = F.transform(
        F.array(F.array_sort(entries)),
        lambda s: F.zip_with(
            s,
            F.slice(s, 2, F.size(s)),
            lambda cur, nxt: F.when(
                nxt.isNull() | (nxt["k"] != cur["k"]),
                F.struct(cur["k"].alias("key"), cur["v"].alias("value")),
            ),
        ),
    )[0]
    if first_seen_order:
        # first position of every key (run starts of the same sort), paired with the kept last value
        firsts = F.transform(
            F.array(F.array_sort(entries)),
            lambda s: F.filter(
                F.zip_with(
                    s,
                    F.concat(F.array(F.lit(None).cast("struct<k:string,i:int,v:string>")), s),
                    lambda cur, prv: F.when(prv.isNull() | (prv["k"] != cur["k"]), cur["i"]),
                ),
                lambda x: x.isNotNull(),
            ),
        )[0]
        last = F.filter(kept, lambda e: e.isNotNull())
        ordered = F.zip_with(firsts, last, lambda i, e: F.struct(i.alias("i"), e["key"].alias("key"), e["value"].alias("value")))
        kept = F.transform(F.array_sort(ordered), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    if drop_empty_keys:
        kept = F.filter(kept, lambda e: e.isNotNull() & (e["key"] != F.lit("")))
    else:
        kept = F.filter(kept, lambda e: e.isNotNull())
    return F.map_from_entries(kept)


def kv_preview_json(c: Column | str, separator: str = "=", delimiter: str = " ") -> Column:
    """The rule builder's key-value preview: C2 rendered as ``JSON.stringify(r, null, 2)``.

    Keys follow JS object order: integer-like keys ("0", "7", ...) first in
    numeric order, then the others in order of first appearance; values are
    the last assigned. (Control characters are escaped with upper-case hex
    digits, JS writes lower case.)
    """
    from signals.functions.text import JS_WHITESPACE, preview_json

    m = kv_parse(c, separator, delimiter, drop_empty_keys=True, whitespace=JS_WHITESPACE, first_seen_order=True)
    ents = F.transform(
        F.map_entries(m),
        lambda e, i: F.struct(
            (~_js_index(e["key"])).alias("o"),
            F.when(_js_index(e["key"]), e["key"].try_cast("bigint")).alias("n"),
            i.alias("i"),
            e["key"].alias("key"),
            e["value"].alias("value"),
        ),
    )
    ordered = F.transform(F.array_sort(ents), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    return preview_json(F.map_from_entries(ordered))


def _js_index(k: Column) -> Column:
    """An array-index-like property name: canonical integer in [0, 2^32 - 2]."""
    return F.coalesce(k.rlike(r"^(0|[1-9][0-9]{0,9})\z") & (k.try_cast("bigint") < F.lit(4294967295)), F.lit(False))


# ---------------------------------------------------------------- C3 regex


def to_java_regex(pattern: str) -> str:
    """Rewrite Python-only syntax to Java.

    Named groups ``(?P<n>...)`` -> ``(?<n>...)``, backreferences ``(?P=n)`` ->
    ``\\k<n>``, Python's end-of-string ``\\Z`` -> Java's ``\\z``, and the
    open lower bound ``{,n}`` -> ``{0,n}``. Escaped backslashes are respected.
    """
    unescaped = r"(?<!\\)((?:\\\\)*)"  # an even number of backslashes before the construct
    p = re.sub(unescaped + r"\(\?P<", r"\1(?<", pattern)
    p = re.sub(unescaped + r"\(\?P=(\w+)\)", r"\1\\k<\2>", p)
    p = re.sub(unescaped + r"\\Z", r"\1\\z", p)
    p = re.sub(unescaped + r"\{,(\d+)\}", r"\1{0,\2}", p)
    return p


def python_semantics(java_pattern: str) -> str:
    """Java flags that make a pattern behave like Python ``re`` on str.

    ``U``: Unicode ``\\d``/``\\w``/``\\s``/``\\b`` and case folding; ``d``: only
    ``\\n`` ends a line for ``.``, ``^`` and ``$``.
    """
    return "(?Ud)" + java_pattern


def optional_groups(pattern: str) -> set[int]:
    """Group numbers that can be left unmatched while the whole pattern matches.

    A group is optional when it sits under a repeat with minimum 0 or inside an
    alternation branch. Spark's ``regexp_extract`` returns '' for such a group,
    Python returns None; we map '' to null only for these groups.
    """
    try:
        from re import _parser as sre_parse  # Python 3.11+
    except ImportError:  # pragma: no cover
        import sre_parse  # type: ignore

    found: set[int] = set()

    def walk(items, optional: bool) -> None:
        for op, av in items:
            name = str(op)
            if name == "SUBPATTERN":
                gid, _, _, sub = av
                if gid is not None and optional:
                    found.add(gid)
                walk(sub, optional)
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                lo, _, sub = av
                walk(sub, optional or lo == 0)
            elif name == "BRANCH":
                _, branches = av
                for b in branches:
                    walk(b, True)
            elif name == "GROUPREF_EXISTS":
                _, yes, no = av
                walk(yes, True)
                if no is not None:
                    walk(no, True)
            elif name in ("ASSERT", "ASSERT_NOT"):
                _, sub = av
                walk(sub, optional or name == "ASSERT_NOT")
            elif name == "ATOMIC_GROUP":
                walk(av, optional)

    walk(sre_parse.parse(pattern), False)
    return found


#: Stands before each group's text in a cut line; any character that lines seldom hold.
_MARK = "\x01"


def regex_parse(c: Column | str, pattern: str, fields: Sequence[str]) -> Column:
    """First match anywhere; groups zipped with ``fields`` up to the shorter.

    No match or an empty pattern gives an empty map; an unmatched optional
    group gives a null value. Raises ``re.error`` for an invalid pattern.
    """
    if not pattern:
        return _empty_map()
    compiled = re.compile(pattern)
    n = min(len(fields), compiled.groups)
    if n == 0:
        return _empty_map()
    jp = to_java_regex(pattern)
    opt = optional_groups(pattern)
    # Python builds a dict: a repeated field name keeps its first position and the last value.
    last_index: dict[str, int] = {}
    for i in range(n):
        last_index[fields[i]] = i
    keys = F.array(*[F.lit(k) for k in last_index])

    def entries(group) -> Column:
        """The map of a line's groups; ``group(i)`` gives group i as text."""
        vals = []
        for i in last_index.values():
            v = group(i + 1)
            vals.append(F.when(v != F.lit(""), v) if i + 1 in opt else v)
        return F.map_from_arrays(keys, F.array(*vals))

    # One replacement turns a matching line into its groups behind marks, which one split takes apart.
    # The lazy start finds the leftmost match, as a search does. Lines that hold the mark already are
    # read group by group.
    end = "\n" if compiled.flags & re.VERBOSE else ""  # closes a comment at the end of such a pattern
    whole = python_semantics(f"\\A(?s:.*?)(?:{jp}{end})(?s:.*+)\\z")
    cut = F.regexp_replace(_col(c), F.lit(whole), F.lit("".join(f"{_MARK}${i + 1}" for i in range(n))))
    each = lambda i: F.regexp_extract(_col(c), python_semantics(jp), i)
    marked = F.contains(_col(c), F.lit(_MARK))
    by_group = F.when(_col(c).rlike(python_semantics(jp)), entries(each)).otherwise(_empty_map())
    # one-element arrays bind the cut line and its pieces, so that each is made once
    by_cut = F.transform(
        F.array(cut),
        lambda r: F.when(
            F.startswith(r, F.lit(_MARK)),
            F.transform(F.array(F.split(r, _MARK, -1)), lambda p: entries(lambda i: p[i]))[0],
        ).otherwise(_empty_map()),
    )[0]
    return F.when(marked, by_group).otherwise(by_cut)


# ---------------------------------------------------------------- C4 rule dispatch


@dataclass(frozen=True)
class ParseRule:
    """A parse rule as the rule builder stores it."""

    type: str = "kv"
    separator: str | None = "="
    delimiter: str | None = " "
    pattern: str = ""
    fields: tuple[str, ...] = field(default_factory=tuple)

    @staticmethod
    def from_config(cfg: dict) -> "ParseRule":
        return ParseRule(
            type=cfg.get("type", "kv"),
            separator=cfg.get("separator", "="),
            delimiter=cfg.get("delimiter", " "),
            pattern=cfg.get("pattern", ""),
            fields=tuple(cfg.get("fields", []) or []),
        )


def compile_rule(rule: ParseRule | dict, c: Column | str) -> Column:
    """Compile a rule into a MAP column for non-empty input; null means a parse error.

    Errors that depend only on the rule (unknown type, empty delimiter or
    separator, invalid regex) are detected here once and yield a null column.
    """
    if isinstance(rule, dict):
        rule = ParseRule.from_config(rule)
    try:
        if rule.type == "kv":
            return kv_parse(c, separator=rule.separator, delimiter=rule.delimiter)
        if rule.type == "regex":
            return regex_parse(c, rule.pattern, list(rule.fields))
    except (ValueError, TypeError, re.error):
        return _null_map()
    return _null_map()


def normalize(
    df: DataFrame,
    rule: ParseRule | dict,
    input_col: str = "raw_data",
    output_col: str = "parsed",
    status_col: str = "parse_status",
) -> DataFrame:
    """Apply a parse rule to a table or stream (C4).

    Empty or null input gives ``{}`` before the rule type is looked at; a parse
    error gives null. ``status_col`` is ``parsed``, ``empty`` or ``error``.
    """
    raw = F.col(input_col)
    parsed = F.when(raw.isNull() | (raw == F.lit("")), _empty_map()).otherwise(compile_rule(rule, raw))
    status = (
        F.when(F.col(output_col).isNull(), F.lit(ERROR))
        .when(F.size(F.col(output_col)) == 0, F.lit(EMPTY))
        .otherwise(F.lit(PARSED))
    )
    return with_once(df, output_col, parsed).withColumn(status_col, status)


def with_once(df: DataFrame, name: str, c: Column) -> DataFrame:
    """Add a column whose expensive expression runs exactly once per row.

    Catalyst pushes a filter on a derived value (``parsed['tcpflag'] = 'SYN'``)
    below the projection that computes it by inlining the expression, so the
    parse would run in the filter and again in the projection. A value that
    has gone through a generator (a one-element ``explode``) is not inlined:
    filters on it stay above, while filters on other columns (tenant,
    partition columns) still reach the scan. Row count is unchanged. The
    expression itself is computed in the projection below, where parts that
    it repeats are computed once; in the generator they would not be.
    """
    tmp = f"__once_{name}"
    return df.withColumn(tmp, c).withColumn(name, F.explode(F.array(tmp))).drop(tmp)


def extract(
    df: DataFrame,
    rule: ParseRule | dict,
    keys: Sequence[str],
    input_col: str = "raw_data",
    output_col: str = "parsed",
) -> DataFrame:
    """The values of a few keys, without the map of all of them (C1/C4 pruned to ``keys``).

    ``output_col`` is a struct with a string for each key: what
    :func:`normalize`'s map has for it, null where it has nothing. A key-value
    line without white space, apart from the delimiter, is not taken apart:
    the last fragment that begins with the key and the separator is found by a
    byte search. Other lines, and rules that this doesn't hold for, go through
    the general parse (once for all keys).
    """
    if isinstance(rule, dict):
        rule = ParseRule.from_config(rule)
    keys = list(dict.fromkeys(keys))
    raw = F.col(input_col)
    text, general = "__kv_text", "__kv_map"
    wide = F.when(raw != F.lit(""), compile_rule(rule, raw))
    searched = [k for k in keys if _searchable(rule, k)]
    if not searched:
        out = with_once(df, general, wide)
        return out.withColumn(output_col, F.struct(*[F.col(general)[k].alias(k) for k in keys])).drop(general)
    # an empty or null line has no fragment to find
    out = df.withColumn(text, F.when(_unspaced(raw, rule.delimiter), F.concat(F.lit(rule.delimiter), raw)))
    rest = F.lit(True) if len(searched) < len(keys) else F.col(text).isNull()
    out = with_once(out, general, F.when(rest & raw.isNotNull(), wide))

    def value(k: str) -> Column:
        if k not in searched:
            return F.col(general)[k]
        head = rule.delimiter + k + rule.separator
        found = F.substring_index(F.substring_index(F.col(text), head, -1), rule.delimiter, 1)
        return F.when(F.col(text).isNull(), F.col(general)[k]).when(F.contains(F.col(text), F.lit(head)), found)

    return out.withColumn(output_col, F.struct(*[value(k).alias(k) for k in keys])).drop(text, general)


def _searchable(rule: ParseRule, key: str) -> bool:
    """Is a fragment of ``key`` what begins with the key and the separator, in a line without further white space?"""
    if rule.type != "kv" or not isinstance(rule.delimiter, str) or len(rule.delimiter) != 1 or not isinstance(rule.separator, str) or not rule.separator:
        return False
    if rule.delimiter in rule.separator or rule.delimiter in key or any(x in PY_WHITESPACE for x in key + rule.separator):
        return False
    return (key + rule.separator).find(rule.separator) == len(key)


def _unspaced(c: Column, delimiter: str) -> Column:
    """No white space other than the delimiter, so that nothing is stripped from keys and values."""
    ascii_only, every = (_char_class([ord(x) for x in PY_WHITESPACE if x != delimiter and ord(x) < most]) for most in (0x80, 0x110000))
    return ~F.when(F.octet_length(c) == F.char_length(c), c.rlike(ascii_only)).otherwise(c.rlike(every))


def _char_class(codes: list[int]) -> str:
    """A regex class of code points, neighbours as ranges (many single members are slow to test)."""
    codes = sorted(codes)
    starts = [x for x in codes if x - 1 not in codes]
    ends = [x for x in codes if x + 1 not in codes]
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends)) + "]"


def split_quarantine(df: DataFrame, status_col: str = "parse_status") -> tuple[DataFrame, DataFrame]:
    """Good rows and the error rows to be written to a quarantine output."""
    return df.filter(F.col(status_col) != F.lit(ERROR)), df.filter(F.col(status_col) == F.lit(ERROR))


# ---------------------------------------------------------------- C5 syslog header

# The generator's line grammar
#   <PRI>VERSION ISO-8601-TIME [log_type] [sender_ip] key=value body
# The body is the rest of the input (line terminators included: ``(?s)`` and ``\z``).
HEADER_PATTERN = r"(?s)^<(\d{1,3})>(\d{1,2}) (\S+) \[([^\]]*)\] \[([^\]]*)\](?: (.*))?\z"
HEADER_FIELDS = ("pri", "version", "event_time", "log_type", "sender_ip", "body")


def parse_header(df: DataFrame, input_col: str = "raw_data", once_per_row: bool = False) -> DataFrame:
    """Split the syslog-style header into typed columns.

    One regex test validates the line; the fields are then cut out with
    ``instr``/``substring_index``/``substr`` (exactly the regex groups once
    the line matches, and half the cost of one ``regexp_extract`` per group).
    ``event_time`` is a TIMESTAMP: ISO-8601 with or without fraction and
    offset; without an offset it is read in the session time zone. Lines
    that do not match get nulls; ``body`` is null when the line ends after
    the sender bracket. ``once_per_row`` puts the fields behind ``with_once``
    (worth it when a filter on a header field, or a window over the event
    time, follows; alone it costs about as much as it saves).
    """
    raw = F.col(input_col)
    ok = raw.rlike(HEADER_PATTERN)
    gt, sp = F.instr(raw, ">"), F.instr(raw, " ")
    rest1 = F.substr(raw, sp + 1)  # TIME [type] [ip] body
    time = F.substring_index(rest1, " ", 1)
    rest2 = F.substr(rest1, F.length(time) + 2)  # [type] [ip] body
    typ = F.substring_index(F.substr(rest2, F.lit(2)), "]", 1)
    rest3 = F.substr(rest2, F.length(typ) + 4)  # [ip] body
    ip = F.substring_index(F.substr(rest3, F.lit(2)), "]", 1)
    tail = F.substr(rest3, F.length(ip) + 3)  # '' or ' ' + body
    fields = F.struct(
        F.when(ok, F.substr(raw, F.lit(2), gt - 2)).try_cast("int").alias("pri"),
        F.when(ok, F.substr(raw, gt + 1, sp - gt - 1)).try_cast("int").alias("version"),
        F.when(ok, time).try_cast("timestamp").alias("event_time"),
        F.when(ok, typ).alias("log_type"),
        F.when(ok, ip).alias("sender_ip"),
        F.when(ok & (F.length(tail) > 0), F.substr(tail, F.lit(2))).alias("body"),
    )
    tmp = "__header"
    out = with_once(df, tmp, fields) if once_per_row else df.withColumn(tmp, fields)
    return out.withColumns({f: F.col(f"{tmp}.{f}") for f in HEADER_FIELDS}).drop(tmp)


# ---------------------------------------------------------------- C6 apply schema

# The four field types of the schema editor.
FIELD_TYPES = ("string", "integer", "datetime", "ip_address")

# Value shapes for the typed field kinds (whole value, ``\z`` = end of input).
IPV4_PATTERN = r"^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\z"
INTEGER_PATTERN = r"^[+-]?[0-9]{1,18}\z"
DATETIME_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?\z"
)


def _starts_with_digit(v: Column) -> Column:
    """A cheap look at a value before its whole pattern is tried."""
    return F.ascii(v).between(48, 57)


def is_ipv4(v: Column) -> Column:
    return F.coalesce(F.octet_length(v).between(7, 15) & _starts_with_digit(v) & v.rlike(IPV4_PATTERN), F.lit(False))


def is_integer(v: Column) -> Column:
    return F.coalesce(F.octet_length(v).between(1, 19) & F.ascii(v).between(43, 57) & v.rlike(INTEGER_PATTERN), F.lit(False))


def is_datetime(v: Column) -> Column:
    shaped = F.octet_length(v).between(10, 40) & _starts_with_digit(v)
    return F.coalesce(shaped & v.rlike(DATETIME_PATTERN) & F.substr(v, F.lit(1), F.lit(10)).try_cast("date").isNotNull(), F.lit(False))


def to_datetime(v: Column) -> Column:
    """Text to TIMESTAMP for the ``datetime`` type; null when not a datetime."""
    return F.when(is_datetime(v), F.regexp_replace(v, " ", "T").try_cast("timestamp"))


def convert(v: Column, typ: str) -> Column:
    """Convert a string value to the Spark type of a schema field type."""
    if typ == "integer":
        return F.when(is_integer(v), v.try_cast("bigint"))
    if typ == "datetime":
        return to_datetime(v)
    if typ == "ip_address":
        return F.when(is_ipv4(v), v)
    if typ == "string":
        return v
    raise ValueError(f"unknown field type {typ!r}")


def apply_schema(
    df: DataFrame,
    fields: Iterable[tuple[str, str]],
    map_col: str = "parsed",
    output_col: str = "record",
    errors_col: str = "cast_errors",
) -> DataFrame:
    """Project the parsed map to a typed struct by field types.

    ``fields`` is the (name, type) list of one schema version, e.g. from
    ``signals.sources.artifacts.schema_fields``. A present value that does not
    convert becomes null and its field name is listed in ``errors_col``.
    ``map_col`` is a map, or a struct such as :func:`extract` makes for these
    fields alone.
    """
    fields = list(fields)
    m = F.col(map_col)
    record = F.struct(*[convert(m.getItem(name), typ).alias(name) for name, typ in fields]) if fields else F.struct()
    # behind a barrier, so that no value is converted again for the list of errors
    out = with_once(df, output_col, record)
    errs = [F.when(m.getItem(name).isNotNull() & F.col(output_col)[name].isNull(), F.lit(name)) for name, typ in fields if typ != "string"]
    errors = F.array_compact(F.array(*errs)) if errs else F.array().cast("array<string>")
    return out.withColumn(errors_col, errors)
