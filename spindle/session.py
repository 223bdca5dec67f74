"""Session construction and shared-storage helpers.

Every job reads its settings from the active session.  The only place a
local folder is chosen is :func:`shared_dir` when ``spark.checkpoint.dir``
is unset (local tests); on a cluster that setting names a shared folder and
every intermediate table, stream checkpoint and model lands under it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans shuffles from runtime sizes,
# splits skewed partitions and coalesces small ones; Arrow batches the few
# Python stages; UTC keeps date/hour functions identical to the SQL oracle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "8192",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stopGracefullyOnShutdown": "true",
    # Stream state (the exact dedup keeps every key) lives in RocksDB, off
    # the JVM heap, with changelog checkpoints instead of full snapshots.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``spindle`` importable in the Python workers of every executor
    (Arrow UDFs are pickled by reference to this package).  The package is
    zipped once on the driver and handed to ``SparkContext.addPyFile``, which
    copies it to every executor; idempotent per SparkContext."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import hashlib
    import io
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in sorted(os.walk(pkg_dir)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    data = buf.getvalue()
    # the zip is a driver-side artifact that Spark itself distributes
    path = os.path.join(tempfile.mkdtemp(prefix="spindle-"), f"spindle-{hashlib.sha1(data).hexdigest()[:12]}.zip")
    with open(path, "wb") as f:
        f.write(data)
    sc.addPyFile(path)
    _SHIPPED.add(key)


def get_spark(master: str | None = None, app: str = "spindle",
              shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Return the active session or build one with :data:`DEFAULT_CONF`.

    ``master`` is only applied when given (cluster submits leave it unset).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    try:
        ship_package(spark)
    except Exception:  # shipping is only needed by the Arrow UDFs
        pass
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream checkpoints.

    Read from ``spark.checkpoint.dir``; only when it is unset (tests on one
    machine) a fresh temporary folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spindle-ckpt-")
    sc.setCheckpointDir(root)
    # setCheckpointDir creates a per-application sub-folder; use it.
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of :func:`shared_dir` for one run of one job."""
    root = shared_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
