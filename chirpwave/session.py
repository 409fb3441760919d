"""SparkSession helpers.

The library never creates a session behind the caller's back: every
operator takes DataFrames/Columns.  These helpers exist for tests, the
bench and the command line, and for the one piece of cluster state the
operators need, the shared checkpoint folder.
"""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every session of ours uses.  Event time is compared with
# DuckDB, so the session zone is pinned to UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # the stream-stream join of P4 has two stateful aggregates upstream
    "spark.sql.streaming.statefulOperator.checkCorrectness.enabled": "true",
    # window state lives in RocksDB (off-heap, spills to local disk) and is
    # checkpointed incrementally as a changelog, not as full snapshots
    STATE_PROVIDER: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings for a batch job on a large cluster (hundreds of executors, ~100 TB),
# to be merged into the cluster's own configuration.  The largest shuffle is
# the whole-text join of the feeds.  Map tasks read 1 GB of input, and 20,000
# reducers take 5 GB each: a sort-merge join and a partial aggregate spill, so
# a reducer need not fit in memory, while tasks x reducers (100,000 x 20,000
# blocks of 50 KB) stays within what the shuffle service and the driver's map
# status can carry.  AQE merges small partitions up to 256 MB and splits
# skewed ones above 8 GB.
CLUSTER_CONF = dict(BASE_CONF, **{
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8g",
    # broadcast only what the planner or AQE has measured below 64 MB
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
})

# Settings for a streaming job.  A stateful operator takes its partition count
# from spark.sql.shuffle.partitions at its checkpoint's first run, keeps it for
# good, and AQE does not coalesce it: one state store and one task per
# partition and micro-batch.  So it follows the cores, not the batch rule.
STREAM_CONF = dict(BASE_CONF, **{
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
})


def _apply(spark: SparkSession, conf: dict[str, str]) -> tuple[dict[str, str], dict[str, str]]:
    """Set the keys the launcher did not set explicitly (spark-submit
    ``--conf`` and the cluster's defaults win).  Returns what was applied and
    what the session refused (static settings), with the reason."""
    given = spark.sparkContext.getConf()
    applied, refused = {}, {}
    for key, value in conf.items():
        if given.contains(key) or not key.startswith("spark.sql."):
            continue
        try:
            spark.conf.set(key, value)
            applied[key] = value
        except AnalysisException as e:
            refused[key] = str(e).partition("\n")[0]
            log.warning("%s was not set: %s", key, refused[key])
    return applied, refused


def apply_cluster_conf(spark: SparkSession, conf: dict | None = None) -> dict[str, str]:
    """Apply ``CLUSTER_CONF`` (or ``conf``) to a batch session; see ``_apply``."""
    return _apply(spark, conf or CLUSTER_CONF)[0]


def apply_stream_conf(spark: SparkSession, state_partitions: int | None = None) -> dict[str, str]:
    """Apply ``STREAM_CONF`` to a streaming session.  The state gets
    ``state_partitions`` partitions, else the launcher's shuffle partitions,
    else one per core of the cluster at this moment."""
    applied, _ = _apply(spark, dict(STREAM_CONF, **{
        "spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism)}))
    if state_partitions:  # an explicit flag wins over the launcher
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        applied["spark.sql.shuffle.partitions"] = str(state_partitions)
    return applied


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a ``with`` block."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "chirpwave", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or (8 if cores == "*" else cores))
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the cluster's configuration names a shared file system
    folder; it is read from the session and never overridden, and a
    cluster session without one is an error (a machine-local folder would
    be lost with its executor).  Only a local-mode session (tests, a
    laptop) gets a private folder when the setting is absent.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not current:
        current = sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        current = tempfile.mkdtemp(prefix="chirpwave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"



def make_folder(spark: SparkSession, path: str) -> None:
    """Make an empty folder on whatever file system ``path`` names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
