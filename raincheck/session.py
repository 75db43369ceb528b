"""Session construction and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every raincheck job relies on. ANSI mode makes a bad cast fail the
# statement (nothing is written), like the relational target it replaces.
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where the aggregate above then needs an
    # exchange of its own (invoice days of a hot store-day).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Adaptive execution may broadcast a shuffled side once its bytes are known.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1 << 20


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 * MB) -> dict:
    """Shuffle and split sizing for a given input size and core count.

    The initial shuffle partition count is what the largest shuffle needs
    at ``target_partition_bytes`` per partition (at least three waves of
    tasks over the cores); AQE coalesces it down for the small shuffles and
    splits skewed partitions above the same size. E.g. 100 TB on 8,000
    cores -> 409,600 initial partitions, 256 MB each.
    """
    parts = max(3 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def build_session(master: str | None = None, app: str = "raincheck",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  input_bytes: int | None = None) -> SparkSession:
    """Return a session with the raincheck defaults.

    On a cluster pass ``master=None`` and let spark-submit decide, and pass
    ``input_bytes`` (the size of the largest input) to size shuffles and
    splits with ``scale_conf``; AQE coalesces small partitions at runtime.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if input_bytes:
        b0 = b.getOrCreate()
        conf.update(scale_conf(input_bytes, b0.sparkContext.defaultParallelism))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Spark removes a query's shuffle files when it ends, not when the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries that are built and run inside leave no shuffle files behind: a job
    of many queries then needs the disk of those that run, not of all. A frame
    that runs twice makes its shuffles again."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir``, or a folder already
    given to ``setCheckpointDir``). When neither is set, a local session gets
    a temporary folder, once per application, handed to ``setCheckpointDir``
    so ``DataFrame.checkpoint()`` uses it too; on a cluster it is an error,
    because executors do not share the driver's folders.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext here
        sc = None
    d = sc.getCheckpointDir() if sc is not None else None
    if not d:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        key = sc.applicationId
        d = _LOCAL_DIRS.get(key)
        if d is None:
            d = tempfile.mkdtemp(prefix="raincheck-ckpt-")
            _LOCAL_DIRS[key] = d
            sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique sub-folder of the shared folder (never reused)."""
    return f"{shared_dir(spark)}/raincheck/{tag}-{uuid.uuid4().hex[:12]}"


__all__ = ["build_session", "shared_dir", "scratch_path", "shuffles_dropped"]
