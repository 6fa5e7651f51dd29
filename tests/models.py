"""Small Python models of the parsing rules, used as test oracles."""

from __future__ import annotations

import re


def kv_model(raw: str, separator: str = "=", delimiter: str = " ") -> dict:
    out: dict = {}
    for piece in raw.split(delimiter):
        if separator in piece:
            key, value = piece.split(separator, 1)
            out[key.strip()] = value.strip()
    return out


def kv_preview_model(raw: str, separator: str = "=", delimiter: str = " ") -> dict:
    js_ws = "\t\x0b\x0c \xa0﻿ " + "".join(chr(c) for c in range(0x2000, 0x200B)) + "  　\n\r  "
    out: dict = {}
    for piece in raw.split(delimiter):
        parts = piece.split(separator)
        if len(parts) >= 2:
            key = parts[0].strip(js_ws)
            if key:
                out[key] = separator.join(parts[1:]).strip(js_ws)
    return out


def regex_model(raw: str, pattern: str, fields: list) -> dict:
    if not pattern:
        return {}
    m = re.search(pattern, raw)
    if not m:
        return {}
    g = m.groups()
    return {fields[i]: g[i] for i in range(min(len(fields), len(g)))}


def normalize_model(raw, rule: dict):
    if not raw:
        return {}
    kind = rule.get("type", "kv")
    try:
        if kind == "kv":
            return kv_model(raw, rule.get("separator", "="), rule.get("delimiter", " "))
        if kind == "regex":
            return regex_model(raw, rule.get("pattern", ""), rule.get("fields", []))
        return None
    except Exception:
        return None
