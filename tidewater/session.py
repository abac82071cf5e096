"""Session helpers: the settings every job here relies on, and scratch space.

Scratch space always lives under the cluster's shared ``spark.checkpoint.dir``.
Where that is unset, a session on one machine (``local[...]``) gets a directory
of its own; on a cluster that is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the operators assume. They are safe to set on a
# session someone else built (no static configs here).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # keep `source=01` a string, never an int (partition discovery)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keys that differ in case are different columns
    "spark.sql.caseSensitive": "true",
    # thousands of paths are listed by some tasks, not each by its own
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    # CSV headers with a repeated name: the last one wins (map builder)
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def ship_code() -> None:
    """Pickle this package's functions by value, so Python workers on any
    executor run them without the package being installed there."""
    try:
        from pyspark import cloudpickle
        import tidewater
        cloudpickle.register_pickle_by_value(tidewater)
    except Exception:  # pragma: no cover - very old cloudpickle
        pass


def configure(spark: SparkSession) -> SparkSession:
    ship_code()
    for k, v in RUNTIME_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - conf locked by the platform
            pass
    return spark


def build_session(master: str | None = None, app: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on one machine (a test
    session) is a directory made and registered, so ``DataFrame.checkpoint()``
    works too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - Spark Connect has no context
            root = None
    if not root and not re.match(r"local(\[|$)", spark.conf.get("spark.master", "local")):
        raise ValueError("spark.checkpoint.dir is unset: on a cluster it must name a shared folder")
    if not root:
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # pragma: no cover - no SparkContext (Spark Connect)
            pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/tidewater/{name}-{uuid.uuid4().hex[:12]}"
