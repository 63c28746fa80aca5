"""Session construction and shared-scratch handling."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  Time zone is pinned so that epoch-ms <->
# timestamp conversion is deterministic; AQE re-plans shuffles at run time
# (partition coalescing, skew-join splitting, broadcast conversion behind
# its size threshold).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state off the JVM heap (large keyed state, no GC pressure) with
    # incremental changelog commits to the checkpoint folder.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "faultline",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's base settings.

    ``master`` defaults to ``local[*]`` only when no master is configured by
    the launcher (spark-submit on a cluster sets one).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    elif "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.master(os.environ.get("FAULTLINE_MASTER", "local[*]"))
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ship_package(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone (callers may hand us a foreign session) and
    make sure executors can import this package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)


# Shuffles that grow with the readings: many small partitions, which AQE puts
# together up to this size, so that a task's sort and hash buffers have one size
# however large the input is.
TASK_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def bound_tasks(spark: SparkSession) -> None:
    """Set ``TASK_CONF`` where the session has no setting of its own."""
    for name, value in TASK_CONF.items():
        if name not in spark.conf.getAll:
            spark.conf.set(name, value)


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that operators with several state variables need, also
    in a session that was made elsewhere."""
    for name in ("spark.sql.streaming.stateStore.providerClass",
                 "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"):
        spark.conf.set(name, BASE_CONF[name])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors' Python workers (what
    ``--py-files`` does), once per application.  Needed by the keyed-state
    stream operators, whose functions are imported on the workers.

    Only for local masters: on a cluster the package is shipped with
    ``spark-submit --py-files`` (or installed on the executors), and nothing
    is staged in a machine-local folder."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED or not sc.master.startswith("local"):
        return
    import zipfile

    import faultline
    pkg_dir = os.path.dirname(os.path.abspath(faultline.__file__))
    out_dir = tempfile.mkdtemp(prefix="faultline-pyfiles-")
    zpath = os.path.join(out_dir, "faultline.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system).  Only when the setting is absent (local tests) do we create
    one under the system temp directory and register it; any other master
    needs the setting, as its machines share no temporary folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    if not root:
        root = tempfile.mkdtemp(prefix="faultline-ckpt-")
        sc.setCheckpointDir(root)
        return sc.getCheckpointDir() or root
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside gives its shuffle files back as soon as it is
    written, not when the driver's garbage collection comes to them."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written under ``path`` in the shared folder, and read from there."""
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
