"""String helpers that reproduce Python/JS string semantics with native Spark expressions.

None of these run Python per row: each returns a Column built from built-in
functions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace() is True):
# TAB LF VT FF CR, the four information separators U+001C-U+001F, SPACE, NEL U+0085,
# NBSP U+00A0, OGHAM SPACE U+1680, U+2000-U+200A, LINE SEP U+2028, PARA SEP U+2029,
# NARROW NBSP U+202F, MEDIUM MATH SPACE U+205F, IDEOGRAPHIC SPACE U+3000.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The characters JavaScript's String.prototype.trim() removes
# (WhiteSpace and LineTerminator of ECMA-262): TAB VT FF SPACE NBSP ZWNBSP U+FEFF,
# the Zs spaces U+1680, U+2000-U+200A, U+202F, U+205F, U+3000, and LF CR U+2028 U+2029.
JS_WHITESPACE = (
    "\t\x0b\x0c \xa0\ufeff\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000\n\r\u2028\u2029"
)


def java_quote(s: str) -> str:
    """Quote ``s`` as a literal for a Java regex (same output as Pattern.quote)."""
    if "\\E" not in s:
        return "\\Q" + s + "\\E"
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def strip_chars(c: Column, chars: str) -> Column:
    """Remove any of ``chars`` from both ends (S4 with a chosen character set)."""
    return F.btrim(c, F.lit(chars))


def py_strip(c: Column) -> Column:
    """Python ``str.strip()`` with no argument (S4). Spark's ``trim`` only strips U+0020."""
    return strip_chars(c, PY_WHITESPACE)


def literal_split(c: Column, delimiter: str) -> Column:
    """Python ``s.split(delimiter)``: literal delimiter, keep empty pieces."""
    if delimiter == "":
        raise ValueError("empty separator")
    return F.split(c, java_quote(delimiter), -1)


def split_first(c: Column, separator: str) -> tuple[Column, Column]:
    """Python ``s.split(separator, 1)`` for strings that contain ``separator`` (S3)."""
    pos = F.instr(c, separator)
    return F.substring_index(c, separator, 1), F.substr(c, pos + F.lit(len(separator)))


def contains_literal(c: Column, s: str) -> Column:
    """``s in c``."""
    return F.instr(c, s) > 0


def decode_replace(c: Column) -> Column:
    """``bytes.decode('utf-8', errors='replace')`` for BINARY or raw text."""
    return F.make_valid_utf8(c.cast("string"))


def base_name(c: Column) -> Column:
    """JS ``path.split('/').pop()``."""
    return F.substring_index(c, "/", -1)


def safe_module_name(c: Column) -> Column:
    """Python ``module_id.replace('/', '_')``."""
    return F.replace(c, F.lit("/"), F.lit("_"))


def iso_local(ts: Column) -> Column:
    """ISO-8601 text with microseconds and a numeric offset, as Python's
    ``isoformat(timespec="microseconds")`` writes it (``+00:00``, never ``Z``) (S12)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def thousands(n: Column) -> Column:
    """Count with a thousands separator, as the history view shows it."""
    return F.format_number(n, 0)


def _json_string(c: Column) -> Column:
    """A JSON string literal for ``c`` (quoted and escaped), via to_json of a one-element array."""
    j = F.to_json(F.array(c.cast("string")))
    return F.substr(j, F.lit(2), F.length(j) - 2)


def preview_json(m: Column) -> Column:
    """A MAP<STRING,STRING> as JS ``JSON.stringify(r, null, 2)`` text.

    Two-space indentation, ``"key": "value"`` lines; ``{}`` for an empty map
    and null for a null map. Entries are in the map's order.
    """
    lines = F.transform(F.map_entries(m), lambda e: F.concat(F.lit("  "), _json_string(e["key"]), F.lit(": "), _json_string(e["value"])))
    body = F.concat(F.lit("{\n"), F.array_join(lines, ",\n"), F.lit("\n}"))
    return F.when(m.isNull(), F.lit(None).cast("string")).when(F.size(m) == 0, F.lit("{}")).otherwise(body)


def json_or_error(c: Column, schema: str, error_prefix: str = "parse error") -> Column:
    """``json.loads`` with a fallback (S15): a struct of the parsed fields plus ``_error``.

    ``_error`` is null when the text parsed and the message otherwise; fields
    of unparseable text are null.
    """
    full = f"{schema}, _corrupt string"
    parsed = F.from_json(c, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    bad = c.isNotNull() & (parsed.isNull() | parsed["_corrupt"].isNotNull())
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    return F.struct(
        *[F.when(~bad, parsed[n]).alias(n) for n in names],
        F.when(bad, F.lit(f"{error_prefix}: malformed JSON")).alias("_error"),
    )
