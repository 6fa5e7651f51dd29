"""op11: the 50 best documents for each benchmark item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signals.llm.common import documents
from signals.llm.registry import register
from signals.llm.treap import index, search

TOP = 50

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS terms FROM documents),
sized AS (SELECT d, doc_id, terms, CAST(len(terms) AS HUGEINT) AS n FROM docs WHERE len(terms) > 0),
total AS (SELECT count(*) AS big_n, sum(n) AS big_l FROM sized),
held AS (SELECT d, unnest(terms) AS term FROM sized),
counts AS (SELECT d, term, count(*) AS tf FROM held GROUP BY d, term),
dfs AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM dfs, total),
items AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS terms FROM benchmark),
asked AS (SELECT DISTINCT i, item_id, unnest(terms) AS term FROM items),
damped AS (SELECT d, doc_id, 50 + (50 * n * big_n) // big_l AS m FROM sized, total),
scores AS (
    SELECT i, item_id, d, doc_id, sum(w * (CAST(1000000000 AS BIGINT) * tf // (1000 * tf + 20 * CAST(m AS BIGINT)))) AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN damped USING (d)
    GROUP BY i, item_id, d, doc_id
),
placed AS (
    SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM placed WHERE rank <= {TOP}
"""


@register("op11_lexical", _SQL)
def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return search(index(documents(spark, sf_dir)), items, TOP)
