"""op2: quality rules over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signals.llm.common import documents
from signals.llm.quality_rules import METRICS, RULES, STOP_WORDS, apply_rules
from signals.llm.registry import register

_RATIOS = {
    "n_words": "n_words",
    "mean_word_chars": "word_chars / n_words",
    "symbol_ratio": "n_symbols / n_words",
    "stop_word_ratio": "n_stop_words / n_words",
    "dup_line_ratio": "n_dup_lines / n_lines",
    "repeat_word_ratio": "n_repeat_words / n_words",
}
_TESTS = " AND ".join(
    f"{_RATIOS[r.metric]} {op} {bound}" for r in RULES for op, bound in ((">=", r.low), ("<=", r.high)) if bound is not None
)
#: n_words >= 50 is the first test, so no ratio that is compared divides by 0.
OP2_SQL = f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
k AS (SELECT *, row_number() OVER () AS rid FROM w),
win AS (SELECT rid, i, ws[i] || chr(10) || ws[i+1] || chr(10) || ws[i+2] AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM k)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i+1, i+2]) AS p FROM dup) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines,
         len(list_filter(ws, lambda x: list_contains([{", ".join(f"'{w}'" for w in STOP_WORDS)}], rtrim(lower(x), '.,;:!?')))) AS n_stop_words
  FROM k LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, {", ".join(METRICS)}, base_failed,
       CASE WHEN base_failed THEN FALSE ELSE {_TESTS} END AS kept
FROM b
"""


@register("op2_quality_rules", oracle=OP2_SQL)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
