"""Queries for detection, scoring, response and grep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.operators.detect import brute_force_login, detect_threshold
from signals.plans.fixtures import TENANT_SQL
from signals.plans.q_parse import log_fields
from signals.plans.registry import register
from signals.session import materialize


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed error events with the entity and a wall-clock event time."""
    p = log_fields(spark, sf_dir, ["user"]).filter(F.col("log_type") == "error")
    return p.select(
        "tenant_id", F.col("parsed").getItem("user").alias("user"), F.col("event_time").cast("timestamp_ntz").alias("event_time")
    )


def login_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed events with the entity, the log type and a wall-clock event time."""
    p = log_fields(spark, sf_dir, ["user"])
    return p.select(
        "tenant_id", "log_type", F.col("parsed").getItem("user").alias("user"),
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
    )


def brute_force(spark: SparkSession, sf_dir: str, threshold: int = 3) -> DataFrame:
    """Slice 1: failures per user per day at or above ``threshold`` (BruteForce_Login preset)."""
    return brute_force_login(login_events(spark, sf_dir), threshold=threshold)


F2_SQL = (
    f"SELECT {TENANT_SQL} AS tenant_id, 'user' || CAST(user_id AS VARCHAR) AS \"user\", "
    "date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, COUNT(*) AS n "
    "FROM events WHERE event_type = 'error' GROUP BY ALL HAVING COUNT(*) >= 3"
)


@register("f2_threshold", F2_SQL)
def f2_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brute_force(spark, sf_dir, 3)


# ------------------------------------------------------------------ F1 rules

from signals.operators.detect import Rule, detect_rules, detect_syn_flood, entity_features  # noqa: E402
from signals.operators.anomaly import explain  # noqa: E402
from signals.operators.risk import risk_scores, top_risks  # noqa: E402
from signals.operators.response import assign_responses, policy_table  # noqa: E402
from signals.operators.grep import grep, route  # noqa: E402
from signals.operators.parse import extract, parse_header  # noqa: E402
from signals.plans.fixtures import deny_logs, raw_logs, table  # noqa: E402

RULES = (
    Rule("BruteForce_Login", "log_type = 'error'", "Major"),
    Rule("HighValue", "value > 400", "Critical"),
    Rule("PriorityZeroPurchase", "priority = 0 AND log_type = 'purchase'", "Minor"),
)


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed log lines with the typed columns the rules refer to."""
    p = log_fields(spark, sf_dir, ["user", "value", "priority"])
    m = F.col("parsed")
    return p.select(
        "event_id", "tenant_id", "log_type",
        m.getItem("user").alias("user"),
        m.getItem("value").try_cast("double").alias("value"),
        m.getItem("priority").try_cast("int").alias("priority"),
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_rules(typed_events(spark, sf_dir), RULES)


DET_SQL = (
    f"det AS (SELECT event_id, {TENANT_SQL} AS tenant_id, 'user' || CAST(user_id AS VARCHAR) AS \"user\", "
    "date_trunc('second', ts) AS event_time, 'BruteForce_Login' AS rule, 'Major' AS severity FROM events WHERE event_type = 'error' "
    f"UNION ALL SELECT event_id, {TENANT_SQL}, 'user' || CAST(user_id AS VARCHAR), date_trunc('second', ts), 'HighValue', 'Critical' "
    "FROM events WHERE CAST(value AS DECIMAL(10,2)) > 400 "
    f"UNION ALL SELECT event_id, {TENANT_SQL}, 'user' || CAST(user_id AS VARCHAR), date_trunc('second', ts), 'PriorityZeroPurchase', 'Minor' "
    "FROM events WHERE event_id % 4 = 0 AND event_type = 'purchase')"
)


@register("f1_rules", f"WITH {DET_SQL} SELECT event_id, \"user\", rule, severity FROM det")
def f1_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).select("event_id", "user", "rule", "severity")


# ------------------------------------------------------------------ F3 SYN flood


def deny_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = extract(parse_header(deny_logs(spark, sf_dir), once_per_row=True), {"type": "kv"}, ["dstip", "srcip", "tcpflag", "packets"], input_col="body")
    m = F.col("parsed")
    return p.select(
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
        m.getItem("dstip").alias("dstip"), m.getItem("srcip").alias("srcip"),
        m.getItem("tcpflag").alias("tcpflag"), m.getItem("packets").try_cast("bigint").alias("packets"),
    )


@register(
    "f3_syn_flood",
    "SELECT '10.9.1.' || CAST(1 + user_id % 20 AS VARCHAR) AS dstip, date_trunc('day', ts) AS window_start, "
    "date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, CAST(SUM(1 + event_id % 50) AS BIGINT) AS syn_packets, "
    "COUNT(DISTINCT user_id % 254) AS n_sources FROM events WHERE event_type = 'error' GROUP BY ALL "
    "HAVING SUM(1 + event_id % 50) >= 100",
)
def f3_syn_flood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_syn_flood(deny_fields(spark, sf_dir), "event_time", threshold=100, window="1 day")


# ------------------------------------------------------------------ F4 features, F7 explanation

TYPES = ("click", "error", "purchase", "signup", "view")
FEATURES = ("n_events", *[f"n_{t}" for t in TYPES], "sum_value", "n_hours")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = typed_events(spark, sf_dir).withColumnRenamed("log_type", "event_type")
    return entity_features(ev, ["tenant_id", "user"], "event_time", "1 day", types=TYPES, value_col="value")


FEAT_SQL = (
    f"feat AS (SELECT {TENANT_SQL} AS tenant_id, 'user' || CAST(user_id AS VARCHAR) AS \"user\", "
    "date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, COUNT(*) AS n_events, "
    + ", ".join(f"COUNT(*) FILTER (WHERE event_type = '{t}') AS n_{t}" for t in TYPES)
    + ", SUM(CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE)) AS sum_value, COUNT(DISTINCT event_type) AS n_types, "
    "COUNT(DISTINCT hour(ts)) AS n_hours, MIN(hour(ts)) AS first_hour, MAX(hour(ts)) AS last_hour FROM events GROUP BY ALL)"
)


@register(
    "f4_entity_features",
    f"WITH {FEAT_SQL} SELECT * EXCLUDE (sum_value, first_hour, last_hour), round(sum_value, 2) AS sum_value, "
    "CAST(first_hour AS INTEGER) AS first_hour, CAST(last_hour AS INTEGER) AS last_hour FROM feat",
)
def f4_entity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).withColumn("sum_value", F.round("sum_value", 2))


F7_SQL = (
    f"WITH {FEAT_SQL}, long AS (UNPIVOT (SELECT tenant_id, \"user\", window_start, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)
    + f" FROM feat) ON {', '.join(FEATURES)} INTO NAME feature VALUE value), "
    "st AS (SELECT feature, avg(value) AS mu, stddev_pop(value) AS sd FROM long GROUP BY feature), "
    "z AS (SELECT l.*, CASE WHEN sd > 0 THEN (value - mu) / sd ELSE 0.0 END AS z FROM long l JOIN st USING (feature)), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, \"user\", window_start ORDER BY round(abs(z), 6) DESC, feature) AS rank FROM z) "
    "SELECT tenant_id, \"user\", window_start, rank, feature, round(value, 4) AS value, round(z, 4) + 0.0 AS z FROM r WHERE rank <= 3"
)


@register("f7_explain", F7_SQL)
def f7_explain(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = explain(features(spark, sf_dir), ["tenant_id", "user", "window_start"], FEATURES, n=3)
    return e.withColumn("value", F.round("value", 4)).withColumn("z", F.round("z", 4))


@register("f7_explain_row_local", F7_SQL)
def f7_explain_row_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 from materialised features and precomputed statistics: ranked inside each row, no shuffle."""
    from signals.operators.anomaly import feature_stats

    feats = materialize(features(spark, sf_dir))
    e = explain(feats, ["tenant_id", "user", "window_start"], FEATURES, n=3, stats=feature_stats(feats, FEATURES))
    return e.withColumn("value", F.round("value", 4)).withColumn("z", F.round("z", 4))


# ------------------------------------------------------------------ F8/F9 risk

WEIGHTS_SQL = "wt AS (SELECT * FROM (VALUES ('Minor', 5.0), ('Major', 15.0), ('Critical', 40.0)) t(severity, weight))"
SCORES_SQL = (
    "sc AS (SELECT tenant_id, \"user\" AS entity, CAST(least(100.0, SUM(weight)) AS DOUBLE) AS score, COUNT(*) AS n_detections "
    "FROM det JOIN wt USING (severity) GROUP BY ALL), "
    "rk AS (SELECT *, dense_rank() OVER (PARTITION BY tenant_id ORDER BY score DESC) AS rank FROM sc)"
)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = detections(spark, sf_dir).withColumnRenamed("user", "entity")
    return risk_scores(d)


@register("f8_risk_scores", f"WITH {DET_SQL}, {WEIGHTS_SQL}, {SCORES_SQL} SELECT * FROM rk")
def f8_risk_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark, sf_dir)


@register(
    "f9_top_risks",
    f"WITH {DET_SQL}, {WEIGHTS_SQL}, {SCORES_SQL} SELECT * FROM rk WHERE tenant_id = 'acme' ORDER BY score DESC, entity LIMIT 10",
)
def f9_top_risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = detections(spark, sf_dir).filter(F.col("tenant_id") == "acme").withColumnRenamed("user", "entity")
    return top_risks(risk_scores(own), "acme", 10)


# ------------------------------------------------------------------ F10 response

POLICY = {"BruteForce_Login": ["Isolate_Host", "Slack_Alert_Bot"], "HighValue": "Block_IP"}
POLICY_SQL = (
    "pol AS (SELECT * FROM (VALUES ('BruteForce_Login', 'Isolate_Host'), ('BruteForce_Login', 'Slack_Alert_Bot'), "
    "('HighValue', 'Block_IP')) t(rule, action))"
)


def responses(spark: SparkSession, sf_dir: str):
    d = detections(spark, sf_dir).withColumnRenamed("user", "entity")
    return assign_responses(d, policy_table(spark, POLICY))


@register(
    "f10_assign_responses",
    f"WITH {DET_SQL}, {POLICY_SQL} SELECT tenant_id, \"user\" AS entity, action, COUNT(*) AS n_detections, "
    "MIN(event_id) AS first_event_id, date_trunc('day', event_time) AS window_start FROM det JOIN pol USING (rule) GROUP BY ALL",
)
def f10_assign_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses(spark, sf_dir)[0]


@register(
    "f10_unmatched",
    f"WITH {DET_SQL}, {POLICY_SQL} SELECT event_id, rule FROM det WHERE rule NOT IN (SELECT rule FROM pol)",
)
def f10_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses(spark, sf_dir)[1].select("event_id", "rule")


# ------------------------------------------------------------------ F11/F12 grep over whole documents and lines

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
ROUTES = {"pii": EMAIL, "license": "License", "token": "token"}


@register(
    "f11_grep_documents",
    f"SELECT doc_id, lang, n_chars FROM documents WHERE regexp_matches(text, '{EMAIL}') OR contains(text, 'License')",
)
def f11_grep_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return grep(docs, [EMAIL, "License"], col="text").select("doc_id", "lang", "n_chars")


@register(
    "f11_grep_logs_none",
    "SELECT event_id FROM events WHERE NOT (event_type IN ('error', 'view') OR (user_id % 254) + 1 BETWEEN 100 AND 149)",
)
def f11_grep_logs_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines matching none of: an error/view header, a source address 10.1.1.100-149."""
    rl = raw_logs(spark, sf_dir)
    return grep(rl, [r"\[(error|view)\]", r"srcip=10\.1\.1\.1[0-4][0-9] "], mode="none").select("event_id")


@register(
    "f12_route_documents",
    f"SELECT doc_id, 'pii' AS route FROM documents WHERE regexp_matches(text, '{EMAIL}') "
    "UNION ALL SELECT doc_id, 'license' FROM documents WHERE contains(text, 'License') "
    "UNION ALL SELECT doc_id, 'token' FROM documents WHERE contains(text, 'token') "
    f"UNION ALL SELECT doc_id, 'default' FROM documents WHERE NOT (regexp_matches(text, '{EMAIL}') "
    "OR contains(text, 'License') OR contains(text, 'token'))",
)
def f12_route_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return route(docs, ROUTES, col="text").select("doc_id", "route")


# ------------------------------------------------------------------ F5/F6 models (rows-only: not SQL-expressible)

from signals.operators.anomaly import isolation_forest_fit, isolation_forest_score, reconstruction_score  # noqa: E402

MODEL_FEATURES = ("n_events", *[f"n_{t}" for t in TYPES], "sum_value", "n_hours")


@register("f5_isolation_forest")
def f5_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IsolationForest_Anomaly over the user-day behaviour features."""
    feats = materialize(features(spark, sf_dir))  # read by count, fit and score: parse the logs once
    model = isolation_forest_fit(feats, MODEL_FEATURES, ["tenant_id", "user", "window_start"], trees=100, sample=256, seed=7)
    scored = isolation_forest_score(feats, model, MODEL_FEATURES)
    return scored.select("tenant_id", "user", "window_start", F.round("anomaly_score", 6).alias("anomaly_score"))


@register("f6_reconstruction_score")
def f6_reconstruction_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AutoEncoder_Behavior: rank-3 PCA reconstruction error of the standardised features."""
    scored = reconstruction_score(features(spark, sf_dir), MODEL_FEATURES, k=3)
    return scored.select("tenant_id", "user", "window_start", F.round("recon_error", 6).alias("recon_error"))


# ------------------------------------------------------------------ F2 variants: sliding sum, distinct count


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = typed_events(spark, sf_dir)
    return t.select("tenant_id", "user", "event_time", "value", F.col("log_type").alias("action"))


@register(
    "f2_threshold_sliding_sum",
    "WITH b AS (SELECT *, date_trunc('day', ts) + INTERVAL 12 HOUR * CAST(hour(ts) >= 12 AS INTEGER) AS b12 FROM events), "
    "w AS (SELECT *, b12 AS ws FROM b UNION ALL SELECT *, b12 - INTERVAL 12 HOUR FROM b) "
    f"SELECT {TENANT_SQL} AS tenant_id, 'user' || CAST(user_id AS VARCHAR) AS \"user\", ws AS window_start, "
    "ws + INTERVAL 1 DAY AS window_end, round(SUM(CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE)), 2) AS total_value "
    "FROM w GROUP BY ALL HAVING SUM(CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE)) >= 500",
)
def f2_threshold_sliding_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of event values per user over 1-day windows sliding every 12 hours, at or above 500."""
    d = detect_threshold(
        user_events(spark, sf_dir), ["tenant_id", "user"], "event_time", "1 day", 500,
        agg="sum", value_col="value", slide="12 hours", out="total_value",
    )
    return d.withColumn("total_value", F.round("total_value", 2))


_SLIDES = (
    "WITH e AS (SELECT {tenant} AS tenant_id, 'user' || CAST(user_id AS VARCHAR) AS \"user\", event_type, event_id, user_id, "
    "epoch_us(date_trunc('second', ts)) AS t FROM events), "
    "w AS (SELECT *, unnest(range(t - t % {slide} - {size} + {slide}, t + 1, {slide})) AS s FROM e WHERE {where}), "
    "p AS (SELECT *, make_timestamp(s) AS window_start, make_timestamp(s + {size}) AS window_end FROM w) "
)
_FIVE_MINUTES, _DAY = 300_000_000, 86_400_000_000
_FINE_SQL = _SLIDES.format(tenant=TENANT_SQL, slide=_FIVE_MINUTES, size=_DAY, where="event_type = 'error'")


@register(
    "f2_threshold_fine_slide",
    _FINE_SQL + "SELECT tenant_id, \"user\", window_start, window_end, COUNT(*) AS n FROM p GROUP BY ALL HAVING COUNT(*) >= 3",
)
def f2_threshold_fine_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with at least 3 failures in any day, looked at every five minutes."""
    return detect_threshold(failures(spark, sf_dir), ["tenant_id", "user"], "event_time", "1 day", 3, slide="5 minutes")


@register(
    "f2_distinct_fine_slide",
    _SLIDES.format(tenant=TENANT_SQL, slide=_FIVE_MINUTES, size=_DAY, where="TRUE")
    + "SELECT tenant_id, \"user\", window_start, window_end, COUNT(DISTINCT event_type) AS n_actions FROM p GROUP BY ALL HAVING COUNT(DISTINCT event_type) >= 4",
)
def f2_distinct_fine_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users doing at least 4 different actions in any day, looked at every five minutes."""
    return detect_threshold(
        user_events(spark, sf_dir), ["tenant_id", "user"], "event_time", "1 day", 4,
        agg="count_distinct", value_col="action", slide="5 minutes", out="n_actions",
    )


@register(
    "f3_syn_flood_sliding",
    _SLIDES.format(tenant=TENANT_SQL, slide=4 * 3_600_000_000, size=_DAY, where="event_type = 'error'")
    + "SELECT '10.9.1.' || CAST(1 + user_id % 20 AS VARCHAR) AS dstip, window_start, window_end, "
    "CAST(SUM(1 + event_id % 50) AS BIGINT) AS syn_packets, COUNT(DISTINCT user_id % 254) AS n_sources FROM p GROUP BY ALL HAVING SUM(1 + event_id % 50) >= 100",
)
def f3_syn_flood_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SYN packets by destination over a day, looked at every four hours."""
    return detect_syn_flood(deny_fields(spark, sf_dir), "event_time", threshold=100, window="1 day", slide="4 hours")


@register(
    "f2_threshold_distinct",
    f"SELECT {TENANT_SQL} AS tenant_id, 'user' || CAST(user_id AS VARCHAR) AS \"user\", date_trunc('day', ts) AS window_start, "
    "date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, COUNT(DISTINCT event_type) AS n_actions FROM events "
    "GROUP BY ALL HAVING COUNT(DISTINCT event_type) >= 3",
)
def f2_threshold_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users doing at least 3 different actions in a day (distinct-count threshold)."""
    return detect_threshold(
        user_events(spark, sf_dir), ["tenant_id", "user"], "event_time", "1 day", 3,
        agg="count_distinct", value_col="action", out="n_actions",
    )


@register(
    "f11_grep_pages",
    "SELECT page_id, url FROM pages WHERE contains(html, '<nav>') AND regexp_matches(html, 'lang=\"(fr|de)\"')",
)
def f11_grep_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages matching all of: a literal tag and a language regex."""
    pages = table(spark, sf_dir, "pages")
    return grep(pages, ["<nav>", 'lang="(fr|de)"'], col="html", mode="all").select("page_id", "url")
