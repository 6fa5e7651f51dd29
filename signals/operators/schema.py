"""Schema inference and the schema catalog.

Inference is one aggregation over the exploded parsed maps, partial before
the shuffle, so its output (one row per group and key) is tiny whatever the
log volume. Quality, history, listing, revision and comparison work on that
small catalog.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signals.functions.text import base_name, thousands
from signals.operators.parse import is_datetime, is_integer, is_ipv4

GROUP = ("tenant_id", "log_type")
# The order in which typed kinds are tried before falling back to string.
TYPE_ORDER = ("datetime", "ip_address", "integer")
CATALOG_COLS = ("tenant_id", "log_type", "version", "pos", "name", "type", "confidence")
# Defaults for a field added in the schema editor.
NEW_FIELD = ("new_field", "string", "Manual")


def _ratio_at_least(n: Column, d: Column, threshold: float) -> Column:
    """n / d >= threshold, exactly, in integer arithmetic."""
    f = Fraction(threshold).limit_denominator(10**6)
    return (d > 0) & (n * F.lit(f.denominator) >= d * F.lit(f.numerator))


def infer_schema(
    df: DataFrame,
    map_col: str = "parsed",
    group: Sequence[str] = GROUP,
    threshold: float = 0.9,
) -> DataFrame:
    """Per (group, key): type and confidence.

    For each key the share of its non-empty values that look like a
    ``datetime``, an ``ip_address`` and an ``integer`` is measured; the first
    kind in that order with share >= ``threshold`` wins, else ``string``.
    ``confidence_pct`` is floor(100 x winner's share); for ``string`` it is the
    share of rows that carry the key. Output columns: group, ``name``,
    ``type``, ``confidence`` ('NN%'), ``confidence_pct``, ``n_rows``,
    ``n_present``, ``n_values``, ``n_match``.
    """
    group = list(group)
    e = df.select(*group, F.posexplode_outer(F.col(map_col)).alias("__pos", "name", "__v"))
    nonempty = F.col("__v").isNotNull() & (F.col("__v") != F.lit(""))
    agg = e.groupBy(*group, "name").agg(
        F.count_if(F.col("__pos").isNull() | (F.col("__pos") == 0)).alias("__first"),
        F.count(F.col("name")).alias("n_present"),
        F.count_if(nonempty).alias("n_values"),
        F.count_if(nonempty & is_datetime(F.col("__v"))).alias("__n_datetime"),
        F.count_if(nonempty & is_ipv4(F.col("__v"))).alias("__n_ip_address"),
        F.count_if(nonempty & is_integer(F.col("__v"))).alias("__n_integer"),
    )
    # one row per group, joined back: the keys of a log type may be very many
    totals = agg.groupBy(*[F.col(g).alias(f"__t_{g}") for g in group]).agg(F.sum("__first").alias("n_rows"))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__t_{g}")) for g in group])
    agg = agg.filter(F.col("name").isNotNull()).join(totals, same).drop(*[f"__t_{g}" for g in group])
    nv = F.col("n_values")
    typ = F.lit("string")
    match = F.col("n_present")
    denom = F.col("n_rows")
    for kind in reversed(TYPE_ORDER):
        ok = _ratio_at_least(F.col(f"__n_{kind}"), nv, threshold)
        typ = F.when(ok, F.lit(kind)).otherwise(typ)
        match = F.when(ok, F.col(f"__n_{kind}")).otherwise(match)
        denom = F.when(ok, nv).otherwise(denom)
    out = agg.withColumns({"type": typ, "__m": match, "__d": denom})
    pct = F.when(F.col("__d") > 0, F.expr("(__m * 100) div __d")).otherwise(F.lit(0)).cast("bigint")
    value_match = F.when(F.col("type") == "string", nv).otherwise(F.col("__m"))
    return out.select(
        *group,
        "name",
        "type",
        F.concat(pct.cast("string"), F.lit("%")).alias("confidence"),
        pct.alias("confidence_pct"),
        F.col("n_rows").cast("bigint").alias("n_rows"),
        F.col("n_present").cast("bigint").alias("n_present"),
        nv.cast("bigint").alias("n_values"),
        value_match.cast("bigint").alias("n_match"),
    )


def schema_quality(inferred: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Per group: ``processed_count`` (rows read) and ``accuracy``.

    accuracy = 100 x values matching their chosen type / all non-empty
    values, rounded to 2 decimals. Computed from the inference output alone:
    no join back to the events.
    """
    g = inferred.groupBy(*group).agg(
        F.max("n_rows").alias("processed_count"),
        F.sum("n_match").alias("__m"),
        F.sum("n_values").alias("__v"),
    )
    acc = F.when(F.col("__v") > 0, F.round(F.col("__m") * F.lit(100.0) / F.col("__v"), 2)).otherwise(F.lit(100.0))
    return g.select(*group, acc.alias("accuracy"), F.col("processed_count").cast("bigint").alias("processed_count"))


def schema_fit(
    df: DataFrame,
    schema: DataFrame,
    map_col: str = "parsed",
    group: Sequence[str] = GROUP,
) -> DataFrame:
    """How well a given schema fits parsed data, per group (D2 for any schema).

    ``schema`` has (group..., name, type), e.g. the current catalog version
    after a manual revision. ``processed_count`` = rows read; ``accuracy`` =
    100 x non-empty values of the schema's fields that match their field
    type / all non-empty values of those fields (2 decimals; 100 when there
    are none). Keys outside the schema do not count. One pass: the exploded
    entries are left-joined with the schema (Spark picks the join by its size)
    and aggregated partially before the shuffle.
    """
    group = list(group)
    e = df.select(*group, F.posexplode_outer(F.col(map_col)).alias("__pos", "__name", "__v"))
    sch = schema.select(*[F.col(g).alias(f"__s_{g}") for g in group], F.col("name").alias("__s_name"), F.col("type").alias("__type"))
    cond = F.col("__name") == F.col("__s_name")
    for g in group:
        cond = cond & (F.col(g) == F.col(f"__s_{g}"))
    j = e.join(sch, cond, "left")
    v = F.col("__v")
    nonempty = F.col("__type").isNotNull() & v.isNotNull() & (v != F.lit(""))
    typ = F.col("__type")
    ok = (
        F.when(typ == "datetime", is_datetime(v))
        .when(typ == "ip_address", is_ipv4(v))
        .when(typ == "integer", is_integer(v))
        .otherwise(F.lit(True))
    )
    g = j.groupBy(*group).agg(
        F.count_if(F.col("__pos").isNull() | (F.col("__pos") == 0)).alias("processed_count"),
        F.count_if(nonempty).alias("__vals"),
        F.count_if(nonempty & ok).alias("__ok"),
    )
    acc = F.when(F.col("__vals") > 0, F.round(F.col("__ok") * F.lit(100.0) / F.col("__vals"), 2)).otherwise(F.lit(100.0))
    return g.select(*group, acc.alias("accuracy"), F.col("processed_count").cast("bigint").alias("processed_count"))


def artifact_name(log_type: Column, run_time: Column) -> Column:
    """``schema_{log_type}_{yyyyMMdd_HHmmss}.xml``."""
    return F.concat(F.lit("schema_"), log_type, F.lit("_"), F.date_format(run_time, "yyyyMMdd_HHmmss"), F.lit(".xml"))


def history_rows(quality: DataFrame, root: str, run_time: Column | None = None, run_id: str | None = None) -> DataFrame:
    """Training-history rows for a run (D3): one per (tenant, log type).

    ``id`` is a run-scoped UUID (Spark has no auto-increment);
    ``xml_file_path`` follows the tenant layout
    ``{root}/{tenant}/artifacts/parsers/schema_{type}_{time}.xml``.
    """
    import uuid

    rt = run_time if run_time is not None else F.current_timestamp()
    rid = run_id or uuid.uuid4().hex
    path = F.concat(
        F.lit(root.rstrip("/") + "/"), F.col("tenant_id"), F.lit("/artifacts/parsers/"), artifact_name(F.col("log_type"), rt)
    )
    return quality.select(
        F.concat(F.lit(rid + "-"), F.col("tenant_id"), F.lit("-"), F.col("log_type")).alias("id"),
        "tenant_id",
        "log_type",
        F.col("accuracy").cast("double").alias("accuracy"),
        F.col("processed_count").cast("bigint").alias("processed_count"),
        path.alias("xml_file_path"),
        rt.cast("timestamp").alias("created_at"),
    )


def append_history(history: DataFrame, path: str) -> None:
    """Append run rows to the history table (parquet, partitioned by tenant) (D3)."""
    history.write.mode("append").partitionBy("tenant_id").parquet(path)


def training_history(history: DataFrame, tenant_id: str) -> DataFrame:
    """One tenant's runs, newest first, with display columns.

    ``rank`` is 1 for the newest run (ties broken by log type);
    ``accuracy_display`` is the percentage with two decimals and '%';
    ``processed_display`` has thousands separators.
    """
    w = Window.partitionBy("tenant_id").orderBy(F.col("created_at").desc(), F.col("log_type"))
    h = history.filter(F.col("tenant_id") == F.lit(tenant_id))
    return h.withColumns(
        {
            "rank": F.row_number().over(w).cast("bigint"),
            "accuracy_display": F.concat(F.format_string("%.2f", F.col("accuracy")), F.lit("%")),
            "processed_display": thousands(F.col("processed_count")),
        }
    ).orderBy("rank")


def list_artifacts(history: DataFrame, path_col: str = "xml_file_path") -> DataFrame:
    """Artifact list per tenant: base file name, log type and time from the name."""
    name = base_name(F.col(path_col))
    pat = r"^schema_(.+)_([0-9]{8}_[0-9]{6})\.xml$"
    return history.select(
        "tenant_id",
        name.alias("file_name"),
        F.regexp_extract(name, pat, 1).alias("artifact_type"),
        F.try_to_timestamp(F.regexp_extract(name, pat, 2), F.lit("yyyyMMdd_HHmmss")).alias("artifact_time"),
    )


def catalog_from_inference(inferred: DataFrame, version: int = 1, group: Sequence[str] = GROUP) -> DataFrame:
    """Catalog rows (version, 0-based pos in name order) from an inference result."""
    w = Window.partitionBy(*group).orderBy("name")
    return inferred.select(
        *group,
        F.lit(version).cast("int").alias("version"),
        (F.row_number().over(w) - 1).cast("int").alias("pos"),
        "name",
        "type",
        "confidence",
    )


def current_schema(catalog: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Rows of the newest version of every (tenant, log type) (D6); none for a schema that was emptied."""
    newest = catalog.groupBy(*[F.col(g).alias(f"__n_{g}") for g in group]).agg(F.max("version").alias("__max"))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__n_{g}")) for g in group])
    rows = catalog.join(newest, same & (F.col("version") == F.col("__max"))).select(*catalog.columns)
    return rows.filter(F.col("name").isNotNull())


def revise_schema(
    catalog: DataFrame,
    tenant_id: str,
    log_type: str,
    remove: Iterable[int] = (),
    add: int | Iterable[tuple[str, str, str]] = (),
    replace: Sequence[tuple[str, str, str]] | None = None,
) -> DataFrame:
    """Write a new version of one schema; earlier versions stay.

    The editor's operations: ``remove`` drops fields by 0-based position,
    ``add`` appends fields (an int adds that many default fields
    'new_field'/'string'/'Manual'), ``replace`` swaps in a whole field list.
    Positions are renumbered. A version without fields is one row with null
    field columns, so it is known to be the newest. Returns the whole catalog
    with the new rows.
    """
    cur = current_schema(catalog).filter((F.col("tenant_id") == tenant_id) & (F.col("log_type") == log_type))
    spark = catalog.sparkSession
    if isinstance(add, int):
        add = [NEW_FIELD] * add
    add = list(add)
    new_version = F.col("version") + F.lit(1)
    own = (F.col("tenant_id") == tenant_id) & (F.col("log_type") == log_type)
    vers = catalog.filter(own).groupBy("tenant_id", "log_type").agg(F.max("version").alias("version"))

    def with_version(new: DataFrame) -> DataFrame:
        none = F.lit(None)
        empty = vers.join(new.select("tenant_id", "log_type").distinct(), ["tenant_id", "log_type"], "left_anti").select(
            "tenant_id", "log_type", new_version.cast("int").alias("version"), none.cast("int").alias("pos"),
            none.cast("string").alias("name"), none.cast("string").alias("type"), none.cast("string").alias("confidence"),
        )
        return catalog.unionByName(new.select(*CATALOG_COLS)).unionByName(empty)

    if replace is not None:
        items = [(tenant_id, log_type, i, n, t, c) for i, (n, t, c) in enumerate(replace)]
        rows = spark.createDataFrame(items, "tenant_id string, log_type string, pos int, name string, type string, confidence string")
        new = vers.join(F.broadcast(rows), ["tenant_id", "log_type"]).select(
            "tenant_id", "log_type", new_version.cast("int").alias("version"), "pos", "name", "type", "confidence"
        )
        return with_version(new)
    removed = set(int(r) for r in remove)
    kept = cur.filter(~F.col("pos").isin(list(removed))) if removed else cur
    w = Window.partitionBy("tenant_id", "log_type").orderBy("pos")
    kept = kept.withColumn("pos", (F.row_number().over(w) - 1).cast("int"))
    new = kept.withColumn("version", new_version.cast("int"))
    if add:
        base = kept.groupBy("tenant_id", "log_type").agg(F.count(F.lit(1)).alias("__n"))
        items = [(tenant_id, log_type, i, n, t, c) for i, (n, t, c) in enumerate(add)]
        rows = spark.createDataFrame(items, "tenant_id string, log_type string, __i int, name string, type string, confidence string")
        extra = (
            vers.join(base, ["tenant_id", "log_type"], "left")
            .join(F.broadcast(rows), ["tenant_id", "log_type"])
            .select(
                "tenant_id",
                "log_type",
                new_version.cast("int").alias("version"),
                (F.coalesce(F.col("__n"), F.lit(0)) + F.col("__i")).cast("int").alias("pos"),
                "name",
                "type",
                "confidence",
            )
        )
        new = new.unionByName(extra)
    return with_version(new)


def schema_diff(before: DataFrame, after: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Before/after field lists side by side with a verdict per field.

    ``verdict`` is ``added``, ``removed``, ``changed`` (type differs) or
    ``same``. Fields that share a name are paired in the order of their
    positions, first with first.
    """
    keys = [*group, "name", "__nth"]

    def side(df: DataFrame, out: str) -> DataFrame:
        order = ["pos", "type"] if "pos" in df.columns else ["type"]
        nth = F.row_number().over(Window.partitionBy(*group, "name").orderBy(*order))
        return df.withColumn("__nth", nth).select(*keys, F.col("type").alias(out))

    j = side(before, "before_type").join(side(after, "after_type"), keys, "full_outer").drop("__nth")
    verdict = (
        F.when(F.col("before_type").isNull(), F.lit("added"))
        .when(F.col("after_type").isNull(), F.lit("removed"))
        .when(~F.col("before_type").eqNullSafe(F.col("after_type")), F.lit("changed"))
        .otherwise(F.lit("same"))
    )
    return j.withColumn("verdict", verdict)


def train_schemas(
    parsed: DataFrame,
    root: str,
    history_path: str,
    map_col: str = "parsed",
    threshold: float = 0.9,
    run_time: Column | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Schema training for every (tenant, log type) in one run: infer -> artifacts -> history.

    Inference reads the logs once (its small result is materialised in the
    shared folder); artifacts go below ``{root}/artifacts/parsers`` and one
    history row per (tenant, log type) is appended to ``history_path``.
    Returns the history rows of this run. Read the artifacts back with
    ``signals.sources.artifacts.read_schema_artifacts`` and apply one with
    ``apply_schema(df, schema_fields(...))``.
    """
    from signals.session import materialize
    from signals.sources.artifacts import write_schema_artifacts
    from signals.sources.zones import zone_root

    inferred = materialize(infer_schema(parsed, map_col, threshold=threshold))
    rt = run_time if run_time is not None else _run_time()
    write_schema_artifacts(catalog_from_inference(inferred), zone_root(root, "artifacts/parsers"), rt)
    hist = materialize(history_rows(schema_quality(inferred), zone_root(root, "artifacts/parsers"), rt, run_id))
    append_history(hist, history_path)
    return hist


def _run_time() -> Column:
    """The run time, fixed once on the driver so every row and file of a run agrees
    (``current_timestamp()`` would be re-read by each of the run's writes)."""
    import datetime as dt

    return F.lit(dt.datetime.now().replace(microsecond=0))
