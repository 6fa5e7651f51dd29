"""Anomaly scoring and explanation (F5 isolation forest, F6 reconstruction error, F7 explanation)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feature_stats(features: DataFrame, feature_cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Population mean and stddev of every feature column: one aggregation, 2 x columns numbers back."""
    aggs = []
    for i, c in enumerate(feature_cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = features.agg(*aggs).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(feature_cols)}


def explain(
    features: DataFrame,
    key: Sequence[str],
    feature_cols: Sequence[str],
    n: int = 3,
    stats: dict[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Top-``n`` features per entity by |z|, the standardised deviation from the population.

    z = (value - mean) / population stddev of that feature over all rows
    (0 when the feature does not vary). Output: key, ``rank`` (1..n),
    ``feature``, ``value``, ``z``. Ties in |z| go to the feature name; a null
    value ranks last. The ranking is done inside each entity's row: nothing
    row-sized is shuffled. Without ``stats`` (from ``feature_stats``) the
    statistics are a one-row aggregate of the same plan.
    """
    key = list(key)
    df = features
    if stats is None:
        x = [F.col(c).cast("double") for c in feature_cols]
        one = features.agg(F.array(*[F.avg(c) for c in x]).alias("__mu"), F.array(*[F.stddev_pop(c) for c in x]).alias("__sd"))
        df = features.crossJoin(F.broadcast(one))  # one row

    def moments(i: int, c: str):
        if stats is None:
            return F.col("__mu")[i], F.col("__sd")[i]
        return tuple(F.lit(None if v is None else float(v)).cast("double") for v in stats[c])

    ents = []
    for i, c in enumerate(feature_cols):
        x = F.col(c).cast("double")
        mu, sd = moments(i, c)
        z = F.when(sd > 0, (x - mu) / sd).otherwise(F.lit(0.0))
        order = F.coalesce(-F.round(F.abs(z), 6), F.lit(1.0))
        ents.append(F.struct(order.alias("o"), F.lit(c).alias("feature"), x.alias("value"), z.alias("z")))
    top = F.slice(F.array_sort(F.array(*ents)), 1, n)
    exploded = df.select(*key, F.posexplode(top).alias("__pos", "__e"))
    return exploded.select(
        *key, (F.col("__pos") + 1).cast("bigint").alias("rank"),
        F.col("__e.feature").alias("feature"), F.col("__e.value").alias("value"), F.col("__e.z").alias("z"),
    )


# ---------------------------------------------------------------- F5 isolation forest (Liu, Ting, Zhou 2008)

EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = "tree_id int, node_id int, feature int, split double, left int, right int, size long, depth int, n_sample long"


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points: 2H(n-1) - 2(n-1)/n."""
    import math

    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER_GAMMA) - 2.0 * (n - 1) / n


def _tree_builder(feature_cols: list[str], seed: int, max_depth: int | None):
    import hashlib
    import math

    import numpy as np
    import pandas as pd

    def draw(*what) -> float:
        """A number from 0 up to 1 that any engine can draw again: the first 32 bits of an MD5."""
        return int(hashlib.md5(":".join(map(str, what)).encode()).hexdigest()[:8], 16) / 2**32

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tid = int(pdf["tree_id"].iloc[0])
        x = pdf[feature_cols].to_numpy(dtype="float64")
        x = np.nan_to_num(x, nan=0.0)
        n = len(x)
        limit = max(1, math.ceil(math.log2(max(n, 2))))
        limit = limit if max_depth is None else min(limit, max_depth)
        rows = []
        stack = [(np.arange(n), 0, 0)]
        while stack:
            idx, node, depth = stack.pop()
            sub = x[idx]
            lo, hi = (sub.min(axis=0), sub.max(axis=0)) if len(idx) else (np.zeros(x.shape[1]),) * 2
            cand = np.flatnonzero(hi > lo)
            if depth >= limit or len(idx) <= 1 or cand.size == 0:
                rows.append((tid, node, -1, 0.0, -1, -1, len(idx), depth, n))
                continue
            f = int(cand[int(draw(seed, tid, node, "feature") * cand.size)])
            split = float(lo[f] + draw(seed, tid, node, "split") * (hi[f] - lo[f]))
            go_left = sub[:, f] < split
            left, right = 2 * node + 1, 2 * node + 2
            rows.append((tid, node, f, split, left, right, len(idx), depth, n))
            stack.append((idx[go_left], left, depth + 1))
            stack.append((idx[~go_left], right, depth + 1))
        return pd.DataFrame(rows, columns=["tree_id", "node_id", "feature", "split", "left", "right", "size", "depth", "n_sample"])

    return build


def isolation_forest_fit(
    features: DataFrame,
    feature_cols: Sequence[str],
    id_cols: Sequence[str],
    trees: int = 100,
    sample: int = 256,
    seed: int = 42,
    max_depth: int | None = None,
) -> DataFrame:
    """Fit an isolation forest; returns the trees as node rows.

    Tree membership is an MD5 of the row's ids (of ids and features where the
    ids repeat, so that rows of one id are dealt out, too), and a tree's splits are drawn
    by MD5s of seed, tree and node (children of node i: 2i + 1 and 2i + 2), so
    that the fit can be recomputed anywhere. Trees are as deep as the logarithm
    of their rows, or ``max_depth``. Rows fall into ``ceil(N / sample)`` buckets and tree ``t`` is built on
    bucket ``t mod buckets`` (so every tree sees about ``sample`` rows, and
    small inputs are shared by several trees). The fit is a sample, as the
    algorithm has it: about ``trees * sample`` rows when there are more;
    scoring covers every row. Each tree is grown in one
    ``applyInPandas`` group of ~``sample`` rows.
    The result has at most trees x (2 x sample) rows. ``features`` is read
    twice here (count, membership) and once more by scoring: pass a
    materialised table (``signals.session.materialize``) when it is costly.
    """
    feature_cols, id_cols = list(feature_cols), list(id_cols)
    ids = features.groupBy(*id_cols).agg(F.count(F.lit(1)).alias("__n")).agg(F.sum("__n"), F.max("__n")).first()
    n, most = ids[0] or 0, ids[1] or 0
    buckets = max(1, -(-n // sample))
    of = id_cols if most <= 1 else [*id_cols, *feature_cols]
    own = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in of])
    h = F.conv(F.substring(F.md5(own), 1, 15), 16, 10).cast("long") % F.lit(buckets)
    member = features.withColumn("__b", h).filter(F.col("__b") < trees)
    member = member.withColumn("tree_id", F.explode(F.sequence(F.col("__b").cast("int"), F.lit(trees - 1), F.lit(int(min(buckets, trees))))))
    x = member.select("tree_id", *[F.col(c).cast("double").alias(c) for c in feature_cols])
    return x.groupBy("tree_id").applyInPandas(_tree_builder(feature_cols, seed, max_depth), NODE_SCHEMA)


def _forest_arrays(model: DataFrame):
    import numpy as np

    pdf = model.toPandas()  # bounded: trees x nodes per tree
    trees = []
    for tid, g in pdf.groupby("tree_id"):
        g = g.sort_values("node_id")
        size = int(g["node_id"].max()) + 1
        arr = {k: np.zeros(size, dtype=t) for k, t in [("feature", "int64"), ("split", "float64"), ("left", "int64"), ("right", "int64"), ("size", "float64"), ("depth", "float64")]}
        for col in arr:
            arr[col][g["node_id"].to_numpy()] = g[col].to_numpy()
        # path length credited at a leaf: its depth plus c(size) for the points not separated further
        arr["leaf"] = arr["depth"] + np.array([c_factor(s) for s in arr["size"]])
        trees.append((arr, float(g["n_sample"].iloc[0])))
    return trees


def isolation_forest_score(
    features: DataFrame,
    model: DataFrame,
    feature_cols: Sequence[str],
    score_col: str = "anomaly_score",
) -> DataFrame:
    """Score rows with a fitted forest: ``2^(-E[h(x)] / c(psi))``; near 1 = anomalous.

    The forest (bounded size) is broadcast once; ``mapInPandas`` walks all
    rows of an Arrow batch through each tree level by level with numpy.
    """
    import numpy as np
    import pandas as pd

    feature_cols = list(feature_cols)
    spark = features.sparkSession
    bc = spark.sparkContext.broadcast(_forest_arrays(model))
    from pyspark.sql import types as T

    out_schema = T.StructType(list(features.schema.fields) + [T.StructField(score_col, T.DoubleType())])

    def score(batches):
        forest = bc.value
        psi = np.mean([n for _, n in forest]) if forest else 1.0
        cpsi = c_factor(psi) or 1.0
        for pdf in batches:
            x = np.nan_to_num(pdf[feature_cols].to_numpy(dtype="float64"), nan=0.0)
            total = np.zeros(len(pdf))
            rows = np.arange(len(pdf))
            for arr, _ in forest:
                node = np.zeros(len(pdf), dtype="int64")
                while True:
                    f = arr["feature"][node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    xi = x[rows[inner], f[inner]]
                    go_left = xi < arr["split"][node[inner]]
                    node[inner] = np.where(go_left, arr["left"][node[inner]], arr["right"][node[inner]])
                total += arr["leaf"][node]
            h = total / max(len(forest), 1)
            yield pdf.assign(**{score_col: np.power(2.0, -h / cpsi)})

    return features.mapInPandas(score, out_schema)


# ---------------------------------------------------------------- F6 reconstruction error (linear auto-encoder = PCA)


def reconstruction_score(
    features: DataFrame,
    feature_cols: Sequence[str],
    k: int = 3,
    score_col: str = "recon_error",
) -> DataFrame:
    """Squared distance between standardised features and their rank-``k`` PCA reconstruction.

    A linear auto-encoder with k hidden units learns the principal subspace
    (Baldi & Hornik 1989), so its reconstruction error is this one. The
    scaler and PCA are fitted with MLlib (distributed aggregates); the
    d x k component matrix is small and the error is a native column
    expression over the vector elements, no Python per row.
    """
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from signals.session import materialize

    cols = list(feature_cols)
    va = VectorAssembler(inputCols=cols, outputCol="__raw", handleInvalid="keep")
    # three passes follow (scaler fit, PCA fit, transform): compute the input once
    vec = materialize(va.transform(features.na.fill(0.0, subset=cols)))
    scaler = StandardScaler(inputCol="__raw", outputCol="__z", withMean=True, withStd=True).fit(vec)
    z = scaler.transform(vec)
    pca = PCA(k=min(k, len(cols)), inputCol="__z", outputCol="__p").fit(z)
    # the components are orthonormal: what the projection misses is |z|^2 - |p|^2
    square = lambda v: F.aggregate(vector_to_array(v), F.lit(0.0), lambda a, x: a + x * x)
    err = F.greatest(square("__z") - square("__p"), F.lit(0.0))
    return pca.transform(z).withColumn(score_col, err).drop("__raw", "__z", "__p")
