"""CSV feed export (M17: K1-K3, S20, O1).

Each feed of a run is one CSV file, ``{root}/feed={type}/dt={as_of}/part-00000.csv``:
one header line, every value double-quoted, inner quotes doubled,
NULL an empty unquoted field.

* **Once.** The rows are computed and written once; an ``Observation`` on that write
  counts them, and a feed without rows is never published.
* **In parallel.** All tasks write parts beside the target. The parts' byte
  lengths, summed in order, give every part its place in the one file, and tasks
  copy them there in pieces of ``PIECE`` bytes. Nothing passes through the
  driver or one task. (File systems that tasks can't write at an offset, such as object
  stores, get the parts themselves, the header in the first alone, so that a
  plain concatenation in name order is the CSV; ``_versions`` names the
  folder with the lengths and offsets a multipart upload needs.)
* **Atomically.** The finished file is renamed over the day's earlier one; a run killed
  before that leaves the earlier file as it was, and its leftovers are
  hidden from readers and deleted by the next run.

Numbers are quoted too; the source quoted the numeric strings its
database driver returned, so the difference is nil in practice.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.stage import stage
from .publish import current, publish

FILE = "part-00000.csv"
WORK = "_work-"
#: Bytes that one task copies at a time, and rows of the copy plan per task.
PIECE = 64 << 20
CHUNK = 4 << 20


class NoDataError(RuntimeError):
    """The feed has no rows (the source raised "No data found.")."""


def feed_path(root: str, feed: str, as_of: dt.date) -> str:
    return f"{root.rstrip('/')}/feed={feed}/dt={as_of.isoformat()}"


def export_feed(df: DataFrame, feed: str, as_of: dt.date, root: str,
                require_rows: bool = True, order_by: Sequence[str] = ()) -> str:
    """Write ``df`` as the ``feed`` CSV of day ``as_of`` under ``root``; return the day's folder.

    Values are quoted and NULL is an empty unquoted field, so it differs from
    ``""``. Raises ``NoDataError``
    (before publishing anything) when ``df`` is empty and ``require_rows`` is
    set. With ``order_by`` the lines are in the order of
    those columns (NULLs last; one range shuffle). A hash of the row breaks
    ties, so a value that most rows share is still split over tasks.
    """
    spark, path = df.sparkSession, feed_path(root, feed, as_of)
    if order_by:
        # the range bounds are sampled in a pass of their own: over stored rows, not over the feed's joins
        df = stage(df, f"feed-{feed}")
        tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        df = df.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in order_by], tie)
    # Spark's CSV writer quotes either every field, NULL too, or only those
    # that need it, so the lines are put together here and written as text
    fields = [F.coalesce(_field(name), F.lit("")) for name in df.columns]
    seen = Observation(f"rows of {feed}")
    lines = df.observe(seen, F.count(F.lit(1)).alias("n")).select(F.concat_ws(",", *fields).alias("value"))
    work = f"{path}/{WORK}{uuid.uuid4().hex}"
    lines.write.option("compression", "none").text(f"{work}/parts")
    if require_rows and not seen.get["n"]:
        _delete(spark, work)
        raise NoDataError(f"No data found for feed {feed!r} on {as_of.isoformat()}.")
    header = ",".join(map(_quoted, df.columns)) + "\n"
    local = _local(spark, path)
    if local is not None:
        _replace(spark, _assemble(spark, work, header.encode("utf-8")), f"{path}/{FILE}")
    else:
        _publish_parts(spark, path, work, header.encode("utf-8"))
    _tidy(spark, path)
    return path


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def _local(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system has it, where the folder is a mounted one; else None."""
    fs, p = _hadoop(spark, path)
    uri = fs.makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _parts(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """``(path, bytes)`` of the part files, in name order: one entry per task of the write, not per row."""
    fs, p = _hadoop(spark, folder)
    found = [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")]
    return sorted(found)


def offsets(sizes: Sequence[int], start: int) -> list[int]:
    """Where parts of these sizes begin, one after the other from ``start``."""
    out, at = [], start
    for size in sizes:
        out.append(at)
        at += size
    return out


def copy_plan(parts: Sequence[tuple[str, int]], start: int, piece: int) -> list[tuple[str, int, int, int]]:
    """``(part, from, length, to)`` pieces that put the parts one after the other from ``start``."""
    out = []
    for (path, size), at in zip(parts, offsets([s for _, s in parts], start), strict=True):
        out += [(path, k, min(piece, size - k), at + k) for k in range(0, size, piece)]
    return out


def _assemble(spark: SparkSession, work: str, header: bytes) -> str:
    """One file of the header and all parts, written by many tasks at their offsets."""
    target = f"{work}/{FILE}"
    local = _local(spark, target)
    parts = [(_local(spark, path), size) for path, size in _parts(spark, f"{work}/parts")]
    total = len(header) + sum(size for _, size in parts)
    with open(local, "wb") as out:
        out.write(header)
        out.truncate(total)
    plan = copy_plan(parts, len(header), PIECE)

    def copy(batches):
        for batch in batches:
            done = 0
            for part, start, length, to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with open(part, "rb") as source, open(local, "r+b") as out:
                    source.seek(start)
                    out.seek(to)
                    while length:
                        chunk = source.read(min(CHUNK, length))
                        if not chunk:
                            raise OSError(f"{part} is shorter than it was")
                        out.write(chunk)
                        length -= len(chunk)
                        done += len(chunk)
                    out.flush()
                    os.fsync(out.fileno())
            yield pa.RecordBatch.from_arrays([pa.array([done])], names=["done"])
    if plan:
        pieces = spark.createDataFrame(plan, "part string, start long, length long, to long").repartition(len(plan))
        copied = pieces.mapInArrow(copy, "done long").agg(F.sum("done")).first()[0]
        if copied != total - len(header):
            raise OSError(f"{copied} of {total - len(header)} bytes were copied")
    return target


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename over an existing file in one step."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    path = jvm.org.apache.hadoop.fs.Path
    context.rename(path(source), path(target), how)
    _delete(spark, source.rsplit("/", 1)[0])


def _publish_parts(spark: SparkSession, path: str, work: str, header: bytes) -> None:
    """Parts as they are, a header part before them, named by a version file with lengths and offsets."""
    fs, first = _hadoop(spark, f"{work}/parts/part-00000--header")
    out = fs.create(first, False)
    out.write(bytearray(header))
    out.close()
    parts = _parts(spark, f"{work}/parts")
    where = offsets([size for _, size in parts], 0)
    publish(spark, path, {"folder": f"{work}/parts", "parts": [[p, size, at] for (p, size), at in zip(parts, where, strict=True)]})


def _tidy(spark: SparkSession, path: str) -> None:
    """Delete what killed or earlier runs left beside the published feed."""
    fs, p = _hadoop(spark, path)
    version = current(spark, path)
    live = version["folder"] if version else ""
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith(WORK) and f"/{name}/" not in f"{live}/":
            fs.delete(s.getPath(), True)


def _quoted(text: str) -> str:
    return '"' + text.replace('"', '""') + '"'


def _field(name: str):
    text = F.col(f"`{name}`").cast("string")
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Read a written feed back as strings (for checks and downstream upload)."""
    # any null marker that no field holds keeps an empty field apart from ""
    reader = (spark.read.option("header", True).option("escape", '"').option("nullValue", "\x00").option("multiLine", True)
              .option("inferSchema", False))
    version = current(spark, path)
    if version is None:
        return reader.csv(path)
    header, *parts = [p for p, size, _ in version["parts"] if size]
    names = reader.csv(header).columns
    schema = ", ".join(f"`{n}` string" for n in names)
    return reader.option("header", False).schema(schema).csv(parts) if parts else spark.createDataFrame([], schema)
