"""Session helpers: a local session for tests/bench and the checkpoint folder.

On a cluster the session is created by the platform; ``ensure_checkpoint_dir``
only reads ``spark.checkpoint.dir`` from it.  A private folder is created only
when that setting is absent (local tests and the bench).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "tillhouse") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting it on the context if needed.

    Order: the context's folder if already set; else ``spark.checkpoint.dir``
    from the session conf (the cluster's shared folder); else, only when
    nothing is configured (local runs), a new private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tillhouse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


HASH_JOIN = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
HASH_JOIN_BYTES = "64m"     # of a shuffled partition; at least the advisory partition size, or Spark ignores it


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_BUCKETS = "4"          # bucket files that a task keeps open; with more, Spark sorts the rest as before


@contextmanager
def _where_unset(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for the jobs inside; one that the session already has is left alone."""
    old = spark.conf.get(key, None)
    if old not in (None, "0", "0b"):
        yield
        return
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key)


def sized_hash_joins(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs inside hash the side of a shuffled join whose partitions are all small, instead of sorting both sides.

    Spark decides by the sizes it has measured, so larger sides are sorted as
    before.
    """
    return _where_unset(spark, HASH_JOIN, HASH_JOIN_BYTES)


def unsorted_buckets(spark: SparkSession) -> AbstractContextManager[None]:
    """Writes inside do not sort a task's rows by bucket when they lie in a few buckets anyway."""
    return _where_unset(spark, OPEN_FILES, OPEN_BUCKETS)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for written intermediate tables next to the checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tables", name)
