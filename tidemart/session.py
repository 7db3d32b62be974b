"""Session and shared-folder helpers.

Lineage cuts and intermediate tables go to the folder the cluster names in
``spark.checkpoint.dir``; only when that is unset (local runs, tests) do we
pick a local scratch folder ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_ROOTS: "weakref.WeakKeyDictionary[SparkSession, str]" = weakref.WeakKeyDictionary()
_OPEN = threading.local()
_MADE: "weakref.WeakKeyDictionary[SparkSession, dict[str, list[str]]]" = weakref.WeakKeyDictionary()


def build_session(master: str | None = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tidemart", extra: dict | None = None) -> SparkSession:
    """Session with AQE (coalescing, skew joins) and UI off.

    On a cluster pass ``master=None`` (spark-submit decides) and size
    ``shuffle_partitions`` to the data: about one partition per 128-256 MB of
    the largest shuffle (e.g. 100 TB of line items -> 400k-800k; AQE
    coalesces small ones), with ``spark.sql.files.maxPartitionBytes`` near
    the same size.
    """
    builder = SparkSession.builder
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediates.

    Reads ``spark.checkpoint.dir`` from the session. Only a local master may
    leave it unset (one scratch folder per session, as in tests): on a cluster
    every executor would write to its own disk, so that raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context, conf only
        sc = None
    root = spark.conf.get(_CKPT_KEY, None) or (sc.getConf().get(_CKPT_KEY, None) if sc else None)
    if not root:
        master = sc.master if sc else "connect"
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"set {_CKPT_KEY} to a folder that all executors share (master is {master})")
        root = _LOCAL_ROOTS.get(spark) or tempfile.mkdtemp(prefix="tidemart-")
        _LOCAL_ROOTS[spark] = root
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def share_code(spark: SparkSession) -> None:
    """Python workers started by ``spark`` also look for modules where this package lies.

    Clusters that ship the package (``--py-files``, an installed wheel) have it
    already; the extra entry of the path does no harm there.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([root, *parts])


def remember(spark: SparkSession, kind: str, name: str) -> str:
    """Note a temporary folder, database or view ("folders", "databases", "views") for ``release``."""
    _MADE.setdefault(spark, {"folders": [], "databases": [], "views": []})[kind].append(name)
    return name


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique directory below the shared root; ``release`` (or ``scratch_freed``) deletes it."""
    path = remember(spark, "folders", f"{shared_root(spark)}/tidemart-work/{label}-{uuid.uuid4().hex[:12]}")
    for made in getattr(_OPEN, "made", []):
        made.append(path)
    return path


def scratch_name(spark: SparkSession, kind: str, label: str) -> str:
    """A unique name for a temporary database or view."""
    return remember(spark, kind, f"tm_{uuid.uuid4().hex[:8]}_{label}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, asked of the file system that Spark would use."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_freed(spark: SparkSession) -> Iterator[None]:
    """Scratch folders that this thread makes inside are deleted at the end, for work whose result is written elsewhere."""
    made: list[str] = []
    _OPEN.made = [*getattr(_OPEN, "made", []), made]
    try:
        yield
    finally:
        _OPEN.made = _OPEN.made[:-1]
        for path in made:
            _delete(spark, path)
            if path in _MADE.get(spark, {}).get("folders", []):
                _MADE[spark]["folders"].remove(path)


def release(spark: SparkSession) -> int:
    """Delete what this session has written or registered as temporary; returns how many things went.

    Call it when results that read such folders have been written elsewhere.
    """
    made = _MADE.pop(spark, {"folders": [], "databases": [], "views": []})
    for name in made["views"]:
        spark.catalog.dropTempView(name)
    for name in made["databases"]:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    for path in made["folders"]:
        _delete(spark, path)
    return sum(len(x) for x in made.values())


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an execution are deleted when it ends.

    Otherwise they stay until the driver happens to collect its garbage, which a
    job of many writes may never do: its disk would hold all its shuffles at once.
    """
    before = spark.conf.get(_CLEANUP_KEY, None)
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_KEY)
        else:
            spark.conf.set(_CLEANUP_KEY, before)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as parquet below the shared root and read it back.

    A durable lineage cut: later stages (and retries after an executor
    loss) read the files instead of recomputing the plan, and the re-read
    carries file statistics for pruning.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
