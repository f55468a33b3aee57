"""Session defaults and shared-storage helpers.

The library never creates a cluster session on its own; ``get_session`` is
for tests, tools and the bench.  ``scratch_dir`` resolves the shared folder
the cluster names in ``spark.checkpoint.dir`` and only invents a local one
when nothing is configured (local tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC timestamps, AQE with skew handling,
# partition values kept as text (``client=007`` stays "007").
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


# How much of the (compact, columnar) input one task gets: its rows are sorted
# as wide text, tens of times their size in the file, and must fit in memory.
INPUT_PER_PARTITION = 8 << 20
INPUT_PER_SCAN = 16 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# A small file counts as this much of a scan: hundreds go to one task.
FILE_COST = 64 << 10
_BOUNDS = {"spark.sql.files.maxPartitionBytes": INPUT_PER_SCAN, "spark.sql.adaptive.advisoryPartitionSizeInBytes": INPUT_PER_SCAN,
           "spark.sql.files.openCostInBytes": FILE_COST}
#: The session's own values of these settings, before ``size_session``.
_OWN: dict[str, dict[str, str | None]] = {}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "adlake") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the SQL settings to an existing session (idempotent)."""
    for k, v in SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session
            pass


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path`` (0 if there is nothing)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def size_session(spark: SparkSession, n_bytes: int) -> None:
    """Tasks that follow the input, whatever its size: shuffles begin with a
    partition for each ``INPUT_PER_PARTITION`` bytes of input (at least
    ``spark.sql.shuffle.partitions``; AQE joins small ones), and scans and
    joined partitions are bounded, so that a task's sort needs no spill."""
    unsize_session(spark)
    own = _OWN.setdefault(spark.sparkContext.applicationId, {k: spark.conf.get(k, None) for k in (_INITIAL, *_BOUNDS)})
    if n_bytes < 4 * INPUT_PER_SCAN:
        return
    wanted = -(-n_bytes // INPUT_PER_PARTITION)
    if wanted > int(own[_INITIAL] or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_INITIAL, str(wanted))
    for k, most in _BOUNDS.items():
        now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own[k]) if own[k] else most
        spark.conf.set(k, str(min(now, most)))


def unsize_session(spark: SparkSession) -> None:
    """The session's own settings again."""
    for k, v in _OWN.get(spark.sparkContext.applicationId, {}).items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediate tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one.  Only a session
    in a single process (master ``local``) may do without: it gets a temp
    folder, once; on a cluster a folder of the driver's machine is of no use
    to executors, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="adlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    else:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not jdir.isDefined():
            spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/adlake/{name}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


@contextmanager
def open_writers(spark: SparkSession, n: int) -> Iterator[None]:
    """Partitioned writes inside keep up to ``n`` files open in a task, so its
    rows need not be sorted by partition first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    own = spark.conf.get(key, None)
    spark.conf.set(key, str(n + 1))  # a task that reaches the setting sorts its other rows
    try:
        yield
    finally:
        spark.conf.unset(key) if own is None else spark.conf.set(key, own)


def sizing_conf(input_bytes: int, executor_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle/scan sizing for a cluster run: enough shuffle partitions that
    each holds about ``target_partition_bytes`` (never fewer than 2x the
    cores); AQE then coalesces small ones and splits skewed ones at the
    advisory size.  Scan splits are capped at 256 MiB."""
    parts = max(2 * executor_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(target_partition_bytes, 256 << 20)),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
