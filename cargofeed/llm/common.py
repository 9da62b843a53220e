"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Rows and bytes of one Arrow batch sent to a Python worker: whole texts, some very
#: long, have to fit a worker's memory several times over.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20

#: A set of ids is broadcast up to this many rows (8 bytes each), counted first.
BROADCAST_IDS = 500_000

_SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session's Python stages."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Computes the set once, cuts its lineage, and survives lost executors.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-stage/{uuid.uuid4().hex}/{label}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and the text with NULL as empty; other columns, whatever
    their names, are left out before any helper column is added."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def without_space(col):
    """Delete ``[\\x20\\x09-\\x0D]`` (six literal replacements, no regular expression)."""
    for ch in _SPACE:
        col = F.replace(col, F.lit(ch))
    return col


#: Tables that this Python worker holds for an operator (a compiled vocabulary, language models).
_held: dict = {}


def held(key, build: Callable):
    """The table of ``key``, built once per worker. Workers are reused: what
    an earlier operator held is dropped first."""
    if key not in _held:
        _held.clear()
        _held[key] = build()
    return _held[key]


def drop_held() -> None:
    _held.clear()


def give_back() -> None:
    """Return freed memory to the system, so that an idle worker takes none from the next stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch] | None],
                schema: str, holds: bool = False) -> DataFrame:
    """``mapInArrow`` with one call per record batch. ``holds``: ``fn`` uses ``held`` tables."""
    def run(batches):
        if not holds:
            drop_held()
        try:
            for batch in batches:
                if batch.num_rows:
                    out = fn(batch)
                    if isinstance(out, pa.RecordBatch):
                        yield out
                    elif out is not None:
                        yield from out
        finally:
            give_back()
    return df.mapInArrow(run, schema)


def per_row(docs: DataFrame, decide: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``decide(docs)`` with every row judged by itself where a ``doc_id`` is NULL or repeated.

    ``decide`` then gets row numbers in its place, unique and in the order of
    the ids (NULL last; by text within one id), and the ids come back in its rows.
    """
    if docs.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").isEmpty():
        return decide(docs)
    # the numbers rise with the range partitions of the sort; written once, so they stay
    rows = docs.orderBy(F.asc_nulls_last("doc_id"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    rows = stage(rows.withColumn("__own_id", F.col("doc_id")).withColumn("doc_id", F.monotonically_increasing_id()), "rows")
    return decide(rows).withColumn("doc_id", F.col("__own_id")).select(docs.columns)


def keep_rows(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is in ``keep(doc_id, n_rows)``, one row per id.

    ``keep`` has unique ids (NULL counts as an id); ``n_rows`` is how many rows
    of ``docs`` carry the id. Ids carried by several rows keep one of them.
    The kept ids are broadcast when counted to be few, else hashed: the text
    rows are then shuffled once but never sorted.
    """
    def pick(ids: DataFrame) -> DataFrame:
        ids = ids.select(F.col("doc_id").alias("__keep_id"))
        ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")
        return docs.join(ids, docs["doc_id"].eqNullSafe(F.col("__keep_id")), "left_semi")

    repeated = keep.filter("n_rows > 1")
    out = pick(keep.filter("n_rows = 1"))
    if repeated.isEmpty():
        return out
    return out.unionByName(pick(repeated).dropDuplicates(["doc_id"]))
