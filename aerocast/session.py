"""Session defaults, the shared scratch folder and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Side tables derived from the data (one row per key, per chunk, ...) have no
# size bound known in advance, so joins to them carry no broadcast hint:
# adaptive execution measures each shuffle stage and turns a join into a
# broadcast join only when the measured side is below this threshold; above
# it the sort-merge join stays. Explicit broadcasts are used only for sides
# bounded by construction (one row per contract feature, the model's leaves).
ADAPTIVE_BROADCAST_BYTES = str(64 * 1024 * 1024)


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "aerocast",
                  checkpoint_dir: str | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the settings the library assumes (UTC, AQE, no UI)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", ADAPTIVE_BROADCAST_BYTES)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings every operator relies on.

    All event times are UTC; timestamp_ntz inputs are read as UTC wall clock.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # key probes reach the Parquet row groups as one IN filter (operators/layout.py)
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", "1000")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and written tables.

    Taken from the session (``spark.checkpoint.dir``). Only when it is unset
    and the master is local, as in tests, a folder of our own is created and
    registered; on a cluster executors couldn't share it, so it is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="aerocast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared root, one per call."""
    return f"{shared_root(spark).rstrip('/')}/aerocast/{name}-{uuid.uuid4().hex}"


def _fs_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in whatever store its scheme names."""
    fs, p = _fs_path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def file_state(spark: SparkSession, path: str) -> tuple:
    """(name, size, modification time) of every file under ``path``: what a reuse of results may be keyed by."""
    fs, p = _fs_path(spark, path)
    files, out = fs.listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))
