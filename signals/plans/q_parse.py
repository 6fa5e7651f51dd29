"""Queries for parsing and typing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.functions.text import JS_WHITESPACE, PY_WHITESPACE
from signals.operators.parse import apply_schema, extract, kv_parse, normalize, parse_header, regex_parse
from signals.plans.fixtures import raw_logs, table
from signals.plans.registry import register

BODY_KEYS = ("user", "action", "srcip", "bytes", "priority", "value")


def parsed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_logs -> header columns -> key-value body map (C5 then C4 with the default kv rule)."""
    return normalize(parse_header(raw_logs(spark, sf_dir), once_per_row=True), {"type": "kv"}, input_col="body")


def log_fields(spark: SparkSession, sf_dir: str, keys) -> DataFrame:
    """As :func:`parsed_logs`, with the values of ``keys`` only; filters on header fields don't repeat the header's work."""
    return extract(parse_header(raw_logs(spark, sf_dir), once_per_row=True), {"type": "kv"}, keys, input_col="body")


@register(
    "c1_kv_parse",
    "SELECT event_id, 'user' || CAST(user_id AS VARCHAR) AS \"user\", event_type AS action, "
    "'10.1.1.' || CAST(1 + user_id % 254 AS VARCHAR) AS srcip, CAST(event_id AS VARCHAR) AS bytes, "
    "CAST(event_id % 4 AS VARCHAR) AS priority, CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) AS value, "
    "CAST(6 AS BIGINT) AS n_keys FROM events",
)
def c1_kv_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rl = raw_logs(spark, sf_dir)
    m = kv_parse(F.regexp_extract("raw_data", r"\] (user=.*)$", 1))
    p = rl.select("event_id", m.alias("m"))
    return p.select("event_id", *[F.col("m").getItem(k).alias(k) for k in BODY_KEYS], F.size("m").cast("bigint").alias("n_keys"))


@register(
    "c2_kv_preview",
    "SELECT event_id, 'user' || CAST(user_id AS VARCHAR) AS k_user, event_type AS k_action, "
    "'value=' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) AS c1_empty_key, "
    "CAST(3 AS BIGINT) AS n_keys, CAST(4 AS BIGINT) AS c1_n_keys FROM events",
)
def c2_kv_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preview parse (C2) next to the backend parse (C1) on lines with empty keys.

    Header pieces and three body pairs are prefixed with '=', so they become
    empty-key fragments ('=x'): the preview drops them, C1 keeps the last one.
    """
    rl = raw_logs(spark, sf_dir)
    line = F.regexp_replace(F.col("raw_data"), r"(^| )(<|[0-9]{4}-|\[|srcip|bytes|value)", "$1=$2")
    p = rl.select(
        "event_id",
        kv_parse(line, drop_empty_keys=True, whitespace=JS_WHITESPACE).alias("m"),
        kv_parse(line).alias("c1"),
    )
    return p.select(
        "event_id",
        F.col("m").getItem("user").alias("k_user"),
        F.col("m").getItem("action").alias("k_action"),
        F.col("c1").getItem("").alias("c1_empty_key"),
        F.size("m").cast("bigint").alias("n_keys"),
        F.size("c1").cast("bigint").alias("c1_n_keys"),
    )


C3_PATTERN = r"\[(error|purchase)\] \[([0-9.]+)\] user=(\S+)(?: nothere=(\S+))?"
C3_FIELDS = ("etype", "sender", "user", "ghost", "extra")


@register(
    "c3_regex_parse",
    "SELECT event_id, CASE WHEN event_type IN ('error', 'purchase') THEN event_type END AS etype, "
    "CASE WHEN event_type IN ('error', 'purchase') THEN '192.168.105.' || CAST(10 + user_id % 21 AS VARCHAR) END AS sender, "
    "CASE WHEN event_type IN ('error', 'purchase') THEN 'user' || CAST(user_id AS VARCHAR) END AS \"user\", "
    "CAST(NULL AS VARCHAR) AS ghost, "
    "CAST(CASE WHEN event_type IN ('error', 'purchase') THEN 4 ELSE 0 END AS BIGINT) AS n_keys FROM events",
)
def c3_regex_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First match anywhere, 4 groups zipped with 5 names, one optional group never taking part."""
    rl = raw_logs(spark, sf_dir)
    p = rl.select("event_id", regex_parse(F.col("raw_data"), C3_PATTERN, C3_FIELDS).alias("m"))
    return p.select(
        "event_id", *[F.col("m").getItem(k).alias(k) for k in C3_FIELDS[:4]], F.size("m").cast("bigint").alias("n_keys")
    )


C4_RULES = {
    "kv_default": {"type": "kv"},
    "regex_errors": {"type": "regex", "pattern": C3_PATTERN, "fields": list(C3_FIELDS)},
    "unknown_type": {"type": "xml"},
}


@register(
    "c4_normalize",
    "WITH s AS (SELECT event_type <> 'view' AS has_input, event_type IN ('error', 'purchase') AS is_match FROM events), "
    "r AS ("
    "SELECT 'kv_default' AS rule, CASE WHEN has_input THEN 'parsed' ELSE 'empty' END AS parse_status FROM s "
    "UNION ALL SELECT 'regex_errors', CASE WHEN has_input AND is_match THEN 'parsed' ELSE 'empty' END FROM s "
    "UNION ALL SELECT 'unknown_type', CASE WHEN has_input THEN 'error' ELSE 'empty' END FROM s) "
    "SELECT rule, parse_status, COUNT(*) AS n FROM r GROUP BY rule, parse_status",
)
def c4_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rules over one scan (views carry no input); outcome counts per rule.

    The per-rule statuses are unpivoted and counted in one aggregation.
    """
    rl = raw_logs(spark, sf_dir).select(F.when(F.col("event_type") != "view", F.col("raw_data")).alias("raw_data"))
    for name, rule in C4_RULES.items():
        rl = normalize(rl, rule, output_col=f"p_{name}", status_col=name)
    st = rl.select(*C4_RULES)
    long = st.unpivot([], list(C4_RULES), "rule", "parse_status")
    return long.groupBy("rule", "parse_status").agg(F.count(F.lit(1)).alias("n"))


@register(
    "c5_parse_header",
    "SELECT event_id, CAST(14 AS INTEGER) AS pri, CAST(1 AS INTEGER) AS version, date_trunc('second', ts) AS event_time, "
    "event_type AS log_type, '192.168.105.' || CAST(10 + user_id % 21 AS VARCHAR) AS sender_ip, "
    "'user=user' || CAST(user_id AS VARCHAR) || ' action=' || event_type || ' srcip=10.1.1.' || CAST(1 + user_id % 254 AS VARCHAR) "
    "|| ' bytes=' || CAST(event_id AS VARCHAR) || ' priority=' || CAST(event_id % 4 AS VARCHAR) "
    "|| ' value=' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) AS body FROM events",
)
def c5_parse_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = parse_header(raw_logs(spark, sf_dir))
    return h.select(
        "event_id", "pri", "version", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "log_type", "sender_ip", "body"
    )


C6_FIELDS = (
    ("event_time", "datetime"),
    ("sender_ip", "ip_address"),
    ("user", "string"),
    ("srcip", "ip_address"),
    ("bytes", "integer"),
    ("priority", "integer"),
    ("value", "integer"),
    ("action", "integer"),
)


def fields_map(df: DataFrame) -> DataFrame:
    """Header fields (as text) merged with the parsed body into one ``fields`` map."""
    head = F.create_map(
        F.lit("event_time"), F.regexp_extract("raw_data", r"^<[0-9]+>[0-9]+ (\S+)", 1),
        F.lit("sender_ip"), F.col("sender_ip"),
    )
    return df.withColumn("fields", F.map_concat(head, F.col("parsed")))


@register(
    "c6_apply_schema",
    "SELECT event_id, date_trunc('second', ts) AS event_time, '192.168.105.' || CAST(10 + user_id % 21 AS VARCHAR) AS sender_ip, "
    "'user' || CAST(user_id AS VARCHAR) AS \"user\", '10.1.1.' || CAST(1 + user_id % 254 AS VARCHAR) AS srcip, "
    "CAST(event_id AS BIGINT) AS bytes, CAST(event_id % 4 AS BIGINT) AS priority, CAST(NULL AS BIGINT) AS value, "
    "CAST(NULL AS BIGINT) AS action, 'value,action' AS cast_errors FROM events",
)
def c6_apply_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [n for n, _ in C6_FIELDS]
    logs = log_fields(spark, sf_dir, names[2:])
    time = F.substring_index(F.substr("raw_data", F.instr("raw_data", " ") + 1), " ", 1)
    head = F.when(F.col("pri").isNotNull(), time).alias("event_time"), F.col("sender_ip")
    logs = logs.withColumn("fields", F.struct(*head, *[F.col("parsed")[n].alias(n) for n in names[2:]]))
    typed = apply_schema(logs, C6_FIELDS, map_col="fields")
    return typed.select(
        "event_id",
        F.col("record.event_time").cast("timestamp_ntz").alias("event_time"),
        *[F.col(f"record.{n}").alias(n) for n, _ in C6_FIELDS[1:]],
        F.array_join("cast_errors", ",").alias("cast_errors"),
    )


def _sql_chars(chars: str) -> str:
    return " || ".join(f"chr({ord(c)})" for c in chars)


WS_SQL = _sql_chars(PY_WHITESPACE)


@register(
    "c1_kv_documents",
    "WITH s AS (SELECT doc_id, string_split(text, ' ') AS parts FROM documents), "
    "f AS (SELECT doc_id, unnest(parts) AS frag, generate_subscripts(parts, 1) AS pos FROM s), "
    f"kv AS (SELECT doc_id, pos, trim(substr(frag, 1, strpos(frag, '=') - 1), {WS_SQL}) AS k, "
    f"trim(substr(frag, strpos(frag, '=') + 1), {WS_SQL}) AS v FROM f WHERE strpos(frag, '=') > 0), "
    "lastv AS (SELECT doc_id, k, arg_max(v, pos) AS v FROM kv GROUP BY doc_id, k) "
    "SELECT d.doc_id, COUNT(lastv.k) AS n_keys, CAST(COALESCE(SUM(length(lastv.k) + length(lastv.v)), 0) AS BIGINT) AS kv_chars "
    "FROM documents d LEFT JOIN lastv USING (doc_id) GROUP BY d.doc_id",
)
def c1_kv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default key-value rule over whole documents (up to 20,000 words each)."""
    docs = table(spark, sf_dir, "documents")
    m = kv_parse(F.col("text"))
    chars = F.aggregate(F.map_entries(F.col("m")), F.lit(0).cast("bigint"), lambda acc, e: acc + F.length(e["key"]) + F.length(e["value"]))
    return docs.select("doc_id", m.alias("m")).select(
        "doc_id", F.size("m").cast("bigint").alias("n_keys"), chars.alias("kv_chars")
    )


PAGE_RULE = r'(?s)<html lang="([a-z-]+)".*?<title>(.*?)</title>'
URL_RULE = r"^(https?)://([^/]+)/([a-z]{2})/([0-9]+)(?:\?page=([0-9]+))?"


@register(
    "c3_regex_pages",
    "SELECT page_id, regexp_extract(html, '(?s)<html lang=\"([a-z-]+)\".*?<title>(.*?)</title>', 1) AS lang, "
    "regexp_extract(html, '(?s)<html lang=\"([a-z-]+)\".*?<title>(.*?)</title>', 2) AS title, "
    "regexp_extract(url, '^(https?)://([^/]+)/([a-z]{2})/([0-9]+)(?:\\?page=([0-9]+))?', 1) AS scheme, "
    "regexp_extract(url, '^(https?)://([^/]+)/([a-z]{2})/([0-9]+)(?:\\?page=([0-9]+))?', 2) AS host, "
    "NULLIF(regexp_extract(url, '^(https?)://([^/]+)/([a-z]{2})/([0-9]+)(?:\\?page=([0-9]+))?', 5), '') AS page "
    "FROM pages",
)
def c3_regex_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regex rules over raw web pages: language and title from the whole HTML, parts of the URL
    (the optional page group is null when absent)."""
    pages = table(spark, sf_dir, "pages")
    h = regex_parse(F.col("html"), PAGE_RULE, ["lang", "title"])
    u = regex_parse(F.col("url"), URL_RULE, ["scheme", "host", "lang_path", "doc", "page"])
    p = pages.select("page_id", h.alias("h"), u.alias("u"))
    return p.select(
        "page_id", F.col("h")["lang"].alias("lang"), F.col("h")["title"].alias("title"),
        F.col("u")["scheme"].alias("scheme"), F.col("u")["host"].alias("host"), F.col("u")["page"].alias("page"),
    )
