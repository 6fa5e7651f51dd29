"""Queries for cases beyond the plain fixture: digit-only ids, repeated names, emptied schemas, groups in patterns, scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.functions.text import iso_local, json_or_error, safe_module_name
from signals.operators.anomaly import NODE_SCHEMA, c_factor, isolation_forest_fit, isolation_forest_score, reconstruction_score
from signals.operators.grep import grep, route
from signals.operators.parse import kv_preview_json, normalize
from signals.operators.schema import catalog_from_inference, current_schema, revise_schema, schema_diff
from signals.operators.tenancy import entitled, grants_table
from signals.plans.fixtures import RAW_LOGS_SQL, TENANT_SQL, raw_logs, table, with_views
from signals.plans.q_detect import FEAT_SQL, features
from signals.plans.q_schema import CAT_CTE, D1_CTES, inferred, stored
from signals.plans.q_sources import EVENT_MODULE_SQL, GRANTS_SQL, with_module
from signals.plans.registry import register
from signals.session import materialize, scratch_path
from signals.sources.artifacts import read_schema_artifacts
from signals.sources.metrics import read_training_metrics, write_training_metrics
from signals.sources.zones import read_zone, write_zone

# ------------------------------------------------------------------ F11 patterns with groups

BACKREFS = [r"([zx])\1", r"([0-9])\1", r"(?P<c>ff)", r"(?P<c>kk)"]
BACKREFS_SQL = " OR ".join(f"contains(text, '{x}')" for x in ("zz", "xx", "ff", "kk", *[str(d) * 2 for d in range(10)]))


@register("f11_grep_backrefs", f"SELECT doc_id FROM documents WHERE {BACKREFS_SQL}")
def f11_grep_backrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns with back references and a group name used twice."""
    return grep(table(spark, sf_dir, "documents"), BACKREFS, col="text").select("doc_id")


@register("f11_grep_backrefs_none", f"SELECT doc_id FROM documents WHERE NOT ({BACKREFS_SQL})")
def f11_grep_backrefs_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grep(table(spark, sf_dir, "documents"), BACKREFS, col="text", mode="none").select("doc_id")


# ------------------------------------------------------------------ many literals at once

#: 500 syllables that end in a rare letter.
LITERALS = [a + b + c for a in "bcdfghjklmnpqrstvwxz" for b in "aeiou" for c in "jkqxz"]
_IN_TEXT = "EXISTS (SELECT 1 FROM unnest({}) AS t(x) WHERE contains(text, x))"


@register("f11_many_literals", f"SELECT doc_id FROM documents WHERE {_IN_TEXT.format(LITERALS)}")
def f11_many_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """500 literals in one expression."""
    return grep(table(spark, sf_dir, "documents"), LITERALS, col="text").select("doc_id")


#: A route for each first letter; "s" and "st" overlap with others' literals.
LETTER_ROUTES = {a: [x for x in LITERALS if x[0] == a] for a in "bcdfghjklm"} | {"s": ["es", "ese", "est", "str"], "st": "st"}
_ROUTES_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{name}' AS route FROM documents WHERE {_IN_TEXT.format([p] if isinstance(p, str) else p)}" for name, p in LETTER_ROUTES.items()
)


@register(
    "f12_many_routes",
    f"WITH r AS ({_ROUTES_SQL}) SELECT * FROM r UNION ALL SELECT doc_id, 'default' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM r)",
)
def f12_many_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve routes of 255 literals, told by one scan of each text."""
    return route(table(spark, sf_dir, "documents"), LETTER_ROUTES, col="text").select("doc_id", "route")


# ------------------------------------------------------------------ ids that look like numbers


@register(
    "a6_numeric_tenants",
    "SELECT printf('%04d', user_id % 5) AS tenant_id, event_type, COUNT(*) AS n FROM events WHERE user_id % 5 = 3 GROUP BY ALL",
)
def a6_numeric_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "zones")
    ev = table(spark, sf_dir, "events").select(F.format_string("%04d", F.col("user_id") % 5).alias("tenant_id"), "event_type", "ts")
    write_zone(ev, root, "data/raw", date_col="ts")
    return read_zone(spark, root, "data/raw", tenant_id="0003").groupBy("tenant_id", "event_type").agg(F.count("*").alias("n"))


@register(
    "a9_numeric_tenants",
    "SELECT CASE WHEN user_id % 2 = 0 THEN '0042' ELSE '42' END AS tenant_id, 'a/b' AS module_id, COUNT(*) AS data_points, "
    "CAST(NULL AS VARCHAR) AS last_error FROM events GROUP BY ALL",
)
def a9_numeric_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenants '0042' and '42' in one root, a module id with '/'."""
    root = scratch_path(spark, "metrics")
    tenant = F.when(F.col("user_id") % 2 == 0, F.lit("0042")).otherwise(F.lit("42"))
    per = table(spark, sf_dir, "events").groupBy(tenant.alias("tenant_id"), F.lit("a/b").alias("module_id")).agg(F.count("*").alias("data_points"))
    none = F.lit(None)
    write_training_metrics(
        per.select("tenant_id", "module_id", F.lit(1.0).alias("trained_pct"), "data_points", none.cast("timestamp").alias("last_trained_at"), none.cast("string").alias("last_error")),
        root,
    )
    modules = spark.createDataFrame([("0042", "a/b"), ("42", "a/b")], "tenant_id string, module_id string")
    return read_training_metrics(spark, root, modules).select("tenant_id", "module_id", "data_points", "last_error")


# ------------------------------------------------------------------ a tenant with two tiers


@register(
    "e3_entitled_two_tiers",
    f"WITH {GRANTS_SQL}, t2 AS (SELECT * FROM (VALUES ('acme', 'basic'), ('acme', 'standard'), ('bravo', 'basic')) t(tenant_id, tier)) "
    f"SELECT event_id, tenant_id, module_id FROM (SELECT event_id, {TENANT_SQL} AS tenant_id, {EVENT_MODULE_SQL} AS module_id FROM events) ev "
    "WHERE EXISTS (SELECT 1 FROM t2 JOIN gr USING (tier) WHERE t2.tenant_id = ev.tenant_id AND gr.module_id = ev.module_id)",
)
def e3_entitled_two_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenants = spark.createDataFrame([("acme", "basic"), ("acme", "Standard"), ("bravo", "basic")], "tenant_id string, tier string")
    return entitled(with_module(raw_logs(spark, sf_dir)), tenants, grants_table(spark)).select("event_id", "tenant_id", "module_id")


# ------------------------------------------------------------------ schemas emptied, names repeated


@register(
    "d6_empty_schema",
    f"{D1_CTES}, {CAT_CTE} SELECT * FROM cat WHERE NOT ((tenant_id = 'acme' AND log_type = 'error') OR (tenant_id = 'bravo' AND log_type = 'click'))",
)
def d6_empty_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One schema replaced by nothing, one with all fields removed: neither has a field any more."""
    cat = stored(catalog_from_inference(inferred(spark, sf_dir)))
    cat = revise_schema(cat, "acme", "error", replace=[])
    return current_schema(revise_schema(cat, "bravo", "click", remove=range(1000)))


@register(
    "d7_repeated_names",
    f"{D1_CTES}, {CAT_CTE} SELECT tenant_id, log_type, name, type AS before_type, type AS after_type, 'same' AS verdict "
    "FROM cat UNION ALL SELECT 'acme', 'error', 'new_field', 'string', 'string', 'same' FROM range(2) "
    "UNION ALL SELECT 'acme', 'error', 'new_field', NULL, 'string', 'added'",
)
def d7_repeated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fields of one name before, three after, in one schema of the whole catalog."""
    cat = stored(catalog_from_inference(inferred(spark, sf_dir)))
    two = revise_schema(cat, "acme", "error", add=2)
    three = revise_schema(two, "acme", "error", add=1)
    return schema_diff(current_schema(two), current_schema(three))


# ------------------------------------------------------------------ C4 with a null delimiter


@register(
    "c4_null_delimiter",
    "SELECT event_id, 'user' || CAST(user_id AS VARCHAR) AS \"user\", event_type AS action, "
    "CAST(event_id % 4 AS VARCHAR) AS priority, 'parsed' AS parse_status FROM events",
)
def c4_null_delimiter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored rule without a delimiter splits at any run of white space."""
    rl = raw_logs(spark, sf_dir).select("event_id", F.replace("raw_data", F.lit(" "), F.lit(" \t\n ")).alias("raw_data"))
    p = normalize(rl, {"type": "kv", "separator": "=", "delimiter": None})
    return p.select("event_id", *[F.col("parsed").getItem(k).alias(k) for k in ("user", "action", "priority")], "parse_status")


# ------------------------------------------------------------------ F5 and F6 in closed form

TWO = ("n_events", "sum_value")
#: (tree, node, feature, split, left, right, size, depth, sample)
FOREST = (
    (0, 0, 0, 2.0, 1, 2, 256, 0, 256), (0, 1, -1, 0.0, -1, -1, 100, 1, 256),
    (0, 2, 1, 300.0, 3, 4, 156, 1, 256), (0, 3, -1, 0.0, -1, -1, 50, 2, 256), (0, 4, -1, 0.0, -1, -1, 2, 2, 256),
    (1, 0, 1, 100.0, 1, 2, 256, 0, 256), (1, 1, -1, 0.0, -1, -1, 150, 1, 256), (1, 2, -1, 0.0, -1, -1, 106, 1, 256),
)


_FIT_TREES, _FIT_SAMPLE, _FIT_SEED, _FIT_DEPTH = 4, 256, 7, 4


def _fit_sql() -> str:
    """The nodes of a small forest, a level at a time: rows of a level's nodes, their ranges, the drawn split."""
    draw = lambda what: f"CAST('0x' || substr(md5('{_FIT_SEED}:' || tree_id || ':' || node_id || ':{what}'), 1, 8) AS BIGINT) / 4294967296.0"
    sql = (
        f"WITH {FEAT_SQL}, x AS (SELECT tenant_id, \"user\", window_start, CAST(n_events AS DOUBLE) AS x0, round(sum_value, 2) AS x1 FROM feat), "
        f"b AS (SELECT CAST(ceil(count(*) / {_FIT_SAMPLE}.0) AS BIGINT) AS buckets FROM x), "
        f"m AS (SELECT *, CAST('0x' || substr(md5('{_FIT_SEED}|' || tenant_id || '|' || \"user\" || '|' || CAST(window_start AS VARCHAR)), 1, 15) AS BIGINT) % buckets AS bucket FROM x, b), "
        f"r0 AS (SELECT t.tree_id, CAST(0 AS BIGINT) AS node_id, x0, x1 FROM m JOIN range({_FIT_TREES}) t(tree_id) ON t.tree_id % least(buckets, {_FIT_TREES}) = bucket), "
        "n AS (SELECT tree_id, count(*) AS n_sample FROM r0 GROUP BY tree_id) "
    )
    for d in range(_FIT_DEPTH + 1):
        sql += (
            f", s{d} AS (SELECT tree_id, node_id, count(*) AS size, min(x0) AS lo0, max(x0) AS hi0, min(x1) AS lo1, max(x1) AS hi1, any_value(n_sample) AS n_sample, "
            "list_concat(CASE WHEN max(x0) > min(x0) THEN [0] ELSE [] END, CASE WHEN max(x1) > min(x1) THEN [1] ELSE [] END) AS cand "
            f"FROM r{d} JOIN n USING (tree_id) GROUP BY tree_id, node_id), "
            f"f{d} AS (SELECT *, CASE WHEN size <= 1 OR len(cand) = 0 OR {d} >= least({_FIT_DEPTH}, greatest(1, ceil(log2(greatest(n_sample, 2))))) THEN -1 "
            f"ELSE cand[1 + CAST(floor({draw('feature')} * len(cand)) AS INTEGER)] END AS feature FROM s{d}), "
            f"p{d} AS (SELECT *, CASE feature WHEN 0 THEN lo0 + {draw('split')} * (hi0 - lo0) WHEN 1 THEN lo1 + {draw('split')} * (hi1 - lo1) ELSE 0 END AS split, {d} AS depth FROM f{d}), "
            f"r{d + 1} AS (SELECT tree_id, 2 * node_id + CASE WHEN CASE feature WHEN 0 THEN x0 ELSE x1 END < split THEN 1 ELSE 2 END AS node_id, x0, x1 "
            f"FROM r{d} JOIN p{d} USING (tree_id, node_id) WHERE feature >= 0)"
        )
    # a node that got no rows is a leaf, too
    nodes = " UNION ALL ".join(f"SELECT tree_id, node_id, feature, split, size, depth, n_sample FROM p{d}" for d in range(_FIT_DEPTH + 1))
    return sql + (
        f", a AS ({nodes}), c AS (SELECT tree_id, 2 * node_id + k AS node_id, depth + 1 AS depth, n_sample FROM a, range(1, 3) t(k) WHERE feature >= 0), "
        "w AS (SELECT tree_id, node_id, feature, split, size, depth, n_sample FROM a UNION ALL "
        "SELECT tree_id, node_id, -1, 0, 0, depth, n_sample FROM c WHERE (tree_id, node_id) NOT IN (SELECT (tree_id, node_id) FROM a)) "
        "SELECT CAST(tree_id AS INTEGER) AS tree_id, CAST(node_id AS INTEGER) AS node_id, CAST(feature AS INTEGER) AS feature, round(CAST(split AS DOUBLE), 6) AS split, "
        "CAST(size AS BIGINT) AS size, CAST(depth AS INTEGER) AS depth, CAST(n_sample AS BIGINT) AS n_sample FROM w"
    )


@register("f5_fitted_nodes", _fit_sql())
def f5_fitted_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fit itself: the nodes of four trees over two features of the user-days."""
    feats = materialize(features(spark, sf_dir).withColumns({"n_events": F.col("n_events").cast("double"), "sum_value": F.round("sum_value", 2)}))
    model = isolation_forest_fit(feats, TWO, ["tenant_id", "user", "window_start"], _FIT_TREES, _FIT_SAMPLE, _FIT_SEED, _FIT_DEPTH)
    nodes = [F.col(c).cast(t).alias(c) for c, t in (("tree_id", "int"), ("node_id", "int"), ("feature", "int"))]
    return model.select(*nodes, F.round("split", 6).alias("split"), F.col("size").cast("long").alias("size"), F.col("depth").cast("int").alias("depth"), F.col("n_sample").cast("long").alias("n_sample"))


@register(
    "f5_fixed_forest",
    f"WITH {FEAT_SQL}, h AS (SELECT tenant_id, \"user\", window_start, "
    f"CASE WHEN n_events < 2 THEN {1 + c_factor(100)!r} WHEN sum_value < 300 THEN {2 + c_factor(50)!r} ELSE {2 + c_factor(2)!r} END "
    f"+ CASE WHEN sum_value < 100 THEN {1 + c_factor(150)!r} ELSE {1 + c_factor(106)!r} END AS h FROM feat) "
    f"SELECT tenant_id, \"user\", window_start, round(CAST(pow(2, -(h / 2) / {c_factor(256)!r}) AS DOUBLE), 6) AS anomaly_score FROM h",
)
def f5_fixed_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring with a given forest of two trees."""
    model = spark.createDataFrame(list(FOREST), NODE_SCHEMA)
    scored = isolation_forest_score(features(spark, sf_dir), model, TWO)
    return scored.select("tenant_id", "user", "window_start", F.round("anomaly_score", 6).alias("anomaly_score"))


@register(
    "f6_two_features",
    f"WITH {FEAT_SQL}, s AS (SELECT avg(CAST(n_events AS DOUBLE)) m1, stddev_samp(CAST(n_events AS DOUBLE)) s1, avg(sum_value) m2, "
    "stddev_samp(sum_value) s2, sign(corr(n_events, sum_value)) g FROM feat) "
    "SELECT tenant_id, \"user\", window_start, "
    "round(CAST(pow((n_events - m1) / s1 - g * (sum_value - m2) / s2, 2) / 2 AS DOUBLE), 4) + 0.0 AS recon_error FROM feat, s",
)
def f6_two_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two standardised features have the components (1, 1) and (1, -1): what the first one misses has a closed form."""
    scored = reconstruction_score(features(spark, sf_dir), TWO, k=1)
    return scored.select("tenant_id", "user", "window_start", (F.round("recon_error", 4) + 0.0).alias("recon_error"))


# ------------------------------------------------------------------ scalars


@register(
    "s9_safe_module_name",
    "SELECT event_id, replace(event_type || '/v' || CAST(user_id % 7 AS VARCHAR) || '/x', '/', '_') AS name FROM events",
)
def s9_safe_module_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    module = F.concat("event_type", F.lit("/v"), (F.col("user_id") % 7).cast("string"), F.lit("/x"))
    return table(spark, sf_dir, "events").select("event_id", safe_module_name(module).alias("name"))


@register("s12_iso_local", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS iso FROM events")
def s12_iso_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In a UTC session, as the driver's is."""
    return table(spark, sf_dir, "events").select("event_id", iso_local(F.col("ts").cast("timestamp")).alias("iso"))


_DEFAULTS_XML = '<LogSchema tenant="acme" type="%s"><Field name="a"/><Field type="integer"/><Field confidence="5%%"/></LogSchema>'


@register(
    "s14_attribute_defaults",
    "SELECT log_type, CAST(p AS INTEGER) AS pos, name, type, confidence FROM (SELECT DISTINCT event_type AS log_type FROM events), "
    "(VALUES (0, 'a', 'string', '100%'), (1, '', 'integer', '100%'), (2, '', 'string', '5%')) v(p, name, type, confidence)",
)
def s14_attribute_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose fields lack attributes, one per event type."""
    root = scratch_path(spark, "artifacts")
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()
    docs = kinds.select(F.format_string(_DEFAULTS_XML, "event_type").alias("xml"), F.lit("acme").alias("tenant_id"), F.col("event_type").alias("artifact"))
    docs.write.partitionBy("tenant_id", "artifact").text(root)
    return read_schema_artifacts(spark, root).select("log_type", "pos", "name", "type", "confidence")


_BROKEN = "event_id % 3 = 0"


@register(
    "s15_json_or_error",
    f"SELECT event_id, CASE WHEN {_BROKEN} THEN NULL ELSE user_id END AS u, CASE WHEN {_BROKEN} THEN 'bad: malformed JSON' END AS error FROM events",
)
def s15_json_or_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON text per event, every third one cut short."""
    text = F.to_json(F.struct(F.col("user_id").alias("u"), "event_type"))
    text = F.when(F.expr(_BROKEN), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    got = table(spark, sf_dir, "events").select("event_id", json_or_error(text, "u long, event_type string", "bad").alias("j"))
    return got.select("event_id", F.col("j.u").alias("u"), F.col("j._error").alias("error"))


@register(
    "s16_preview_json",
    with_views(
        "SELECT event_id, '{' || chr(10) || '  \"user\": \"user' || CAST(user_id AS VARCHAR) || '\",' || chr(10) || "
        "'  \"action\": \"' || event_type || '\",' || chr(10) || '  \"srcip\": \"10.1.1.' || CAST(1 + user_id % 254 AS VARCHAR) || '\",' || chr(10) || "
        "'  \"bytes\": \"' || CAST(event_id AS VARCHAR) || '\",' || chr(10) || '  \"priority\": \"' || CAST(event_id % 4 AS VARCHAR) || '\",' || chr(10) || "
        "'  \"value\": \"' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || '\"' || chr(10) || '}' AS preview FROM raw_logs",
        RAW_LOGS_SQL,
    ),
)
def s16_preview_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_logs(spark, sf_dir).select("event_id", kv_preview_json("raw_data").alias("preview"))
