"""Scalar column functions (S1-S17) shared by the operators."""

from signals.functions.text import (  # noqa: F401
    JS_WHITESPACE,
    PY_WHITESPACE,
    base_name,
    contains_literal,
    decode_replace,
    iso_local,
    json_or_error,
    java_quote,
    literal_split,
    preview_json,
    py_strip,
    safe_module_name,
    split_first,
    strip_chars,
    thousands,
)
