"""Spark session settings for the feed jobs.

The settings encode the plan choices the operators rely on:

* AQE on, with skew-join splitting and partition coalescing: hot keys (one
  MAWB, one order or one company holding a large share of rows) are split at
  run time instead of stalling one task.
* Estimate-based broadcast joins are off (``autoBroadcastJoinThreshold=-1``).
  A file-size estimate is not a bound on the in-memory size of a side, so
  broadcasts happen only (a) where an operator has counted the side against
  a row bound first (``operators.joins.broadcast_if_bounded``) or (b) where
  AQE has *measured* a materialised shuffle stage below
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
* UTC session time zone: timestamps are cast to dates throughout.
* ANSI mode stays on (Spark 4 default): a zero exchange rate raises, as the
  source dialect does, instead of silently producing NULL.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cargofeed", extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the feed defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (about 128-256 MB per partition).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL-level defaults to an existing session (e.g. one a driver built).

    Only runtime-modifiable SQL settings are touched.
    """
    for key, value in DEFAULT_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


#: Spark's setting by which an execution deletes its shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block delete their shuffle files when they end.

    Otherwise the files of every stored and staged table stay until the driver's garbage is collected, and
    a plan of many staged steps holds the shuffles of all of them. What was written is read back from the table.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    The cluster names it in ``spark.checkpoint.dir``; that value is always
    used when present. Only a local master may leave it unset and gets a fresh
    temporary folder; on a cluster that folder would be another one on every
    machine, so an unset value raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="cargofeed-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
