"""op7: all conversations, snapshots collapsed, a rendered row per turn."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signals.llm.chat import chat_format
from signals.llm.registry import register

#: Conversations compare by the text of all turns up to each; chr(1) to chr(3) don't occur in it.
OP7_SQL = """
WITH t AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations),
p AS (
  SELECT conv_id, pos, n,
         md5(string_agg(coalesce(role, chr(3)) || chr(1) || coalesce(text, chr(3)), chr(2))
             OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)) AS h
  FROM t),
f AS (SELECT min(conv_id) AS conv_id, pos AS n_turns, h, count(*) AS copies FROM p WHERE pos = n GROUP BY pos, h),
k AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos = f.n_turns AND p.h = f.h AND p.pos < p.n))
SELECT c.conv_id, c.turn,
       '<|im_start|>' || coalesce(c.role, '') || chr(10) || coalesce(c.text, '') || '<|im_end|>' || chr(10) AS rendered,
       k.n_turns, k.copies
FROM conversations c JOIN k ON c.conv_id IS NOT DISTINCT FROM k.conv_id
"""


@register("op7_chat", oracle=OP7_SQL)
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))
