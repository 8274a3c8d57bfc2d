"""Session construction and shared-storage locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Keys already set by the cluster (spark-submit,
# spark-defaults.conf) win over these; see ``build_session``.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Stream-stream join and aggregation state lives in RocksDB, off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit only each micro-batch's changes; full snapshots are made in the
    # background instead of on every batch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Largest number of rows a side may have to be broadcast by our own joins
# (window totals, weather readings: fixed-width rows of about 100 bytes, so at
# most ~100 MB). Override per session with this key.
BROADCAST_MAX_ROWS_KEY = "stationflow.broadcast.maxRows"
BROADCAST_MAX_ROWS_DEFAULT = 1_000_000


def build_session(master: str | None = None, app_name: str = "stationflow",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or get) a session with the defaults above.

    ``master`` is only for local runs and tests; on a cluster leave it to
    spark-submit. ``conf`` overrides the defaults.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def local_master(master: str) -> bool:
    """True if driver and executors are one process on one machine."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder and
    is used as is. Only in local mode (unit tests, a laptop) and when nothing is
    configured do we create a fresh private folder under the system temp dir: on
    a cluster executors would write to their own disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not local_master(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               f"executors share (master: {sc.master})")
        configured = tempfile.mkdtemp(prefix="stationflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder, for landed files, sinks and
    stream checkpoints. ``unique`` appends a fresh id so runs never collide."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    tail = list(parts) + ([uuid.uuid4().hex] if unique else [])
    return "/".join([base, "stationflow", *tail])


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme (for python-side file listing in tests)."""
    return path[len("file:"):] if path.startswith("file:") else path


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """True if the shared file system has this file or folder."""
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder of the shared file system."""
    fs, where = _file_system(spark, path)
    return fs.getContentSummary(where).getLength()


def publish(spark: SparkSession, staged: str, target: str) -> bool:
    """Rename a whole folder to its final name; False, and the staged copy goes, if
    another attempt has published it meanwhile."""
    fs, source = _file_system(spark, staged)
    _, final = _file_system(spark, target)
    fs.mkdirs(final.getParent())
    if fs.exists(final):
        fs.delete(source, True)
        return False
    if not fs.rename(source, final):
        raise OSError(f"could not publish {target}")
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file of the shared file system, None if there is none."""
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small text file of the shared file system."""
    fs, where = _file_system(spark, path)
    stream = fs.create(where, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def broadcast_max_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_MAX_ROWS_KEY, str(BROADCAST_MAX_ROWS_DEFAULT)))
