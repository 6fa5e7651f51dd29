"""Session helpers: a tuned local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "signals") -> SparkSession:
    """Build (or reuse) a local session with the settings the library expects.

    On a cluster the deployment provides the session; nothing here is required
    by the operators themselves.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, as named by ``spark.checkpoint.dir``.

    The cluster's setting wins. Where none is set, a local session (all tasks
    in this machine's process) gets a temporary folder; on a cluster, whose
    executors would each see their own, it is an error.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="signals-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    root = shared_dir(spark)
    return f"{root}/signals-{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Does a path (or pattern) match anything, on whatever file system it is?"""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path on the machines' own or mounted file system; None where Hadoop sees another one there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def small_table(spark: SparkSession, rows: list[tuple], schema: str):
    """Rows from the driver as a relation whose size Spark knows, so that it picks the join by that size."""
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(T.StructType.fromDDL(schema))
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return spark.createDataFrame(pa.table([pa.array(list(c), f.type) for c, f in zip(columns, kinds)], schema=kinds))


def materialize(df):
    """Compute ``df`` once and cut its lineage: a reliable checkpoint in the shared folder.

    For inputs that an operator reads several times (model fitting and
    scoring): later passes read the checkpoint files instead of recomputing
    the upstream plan, and a lost executor does not send them back to it.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Keys that Spark lets a running session change (SQL runtime settings).
_RUNTIME_KEYS = (
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.coalescePartitions.enabled",
    "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    "spark.sql.shuffle.partitions",
    "spark.sql.files.maxPartitionBytes",
    "spark.sql.autoBroadcastJoinThreshold",
    "spark.sql.streaming.stateStore.providerClass",
)


def recommended_conf(input_bytes: int, total_cores: int, shuffle_partition_bytes: int = 200 << 20) -> dict[str, str]:
    """Settings sized for a job that reads ``input_bytes`` on ``total_cores`` cores.

    Shuffle partitions target ~200 MB each (never fewer than 3 per core, so
    every core has work and a slow task is not the whole stage); adaptive
    execution then coalesces small ones and splits skewed ones. Text and
    parquet splits of 256 MB keep file scans at a few thousand tasks per TB.
    """
    parts = max(3 * total_cores, -(-int(input_bytes) // shuffle_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def apply_recommended(spark: SparkSession, input_bytes: int, total_cores: int | None = None, force: bool = False) -> dict[str, str]:
    """Set the recommended runtime settings that the deployment has not set (all of them with ``force``).

    Returns what was set. Settings given explicitly at submit time win.
    """
    cores = total_cores or spark.sparkContext.defaultParallelism
    explicit = dict(spark.sparkContext.getConf().getAll())
    done = {}
    for k, v in recommended_conf(input_bytes, cores).items():
        if k in _RUNTIME_KEYS and (force or k not in explicit):
            spark.conf.set(k, v)
            done[k] = v
    return done
