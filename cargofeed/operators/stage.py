"""Staging small, reused intermediates as written tables.

A DataFrame read by several branches of one plan is recomputed by each
branch when Catalyst prunes the references differently (exchange reuse then
fails). Writing it once as parquet under the cluster's shared checkpoint
folder (``spark.checkpoint.dir``) and reading it back computes it once, cuts
the lineage (a lost executor does not recompute it) and costs a single job,
where ``DataFrame.checkpoint()`` computes an uncached plan twice.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir, shuffles_dropped


_runs: list[list[str]] = []  # folders written inside each open ``staged_run``


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to ``{checkpoint dir}/cargofeed-stage/<run>/<label>`` and read it back."""
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/cargofeed-stage/{uuid.uuid4().hex}"
    if _runs:
        _runs[-1].append(folder)
    path = f"{folder}/{label}"
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_run(spark: SparkSession):
    """Delete the tables staged inside the block when it ends; results must be written by then."""
    _runs.append([])
    try:
        yield
    finally:
        for folder in _runs.pop():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
