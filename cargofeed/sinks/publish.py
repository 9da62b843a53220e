"""Atomic publishing: new files first, then one small file that names them.

A version is a folder no reader looks at until ``_versions/<number>`` exists.
That file is created, never overwritten, after the version's data is complete,
so a run killed at any moment leaves the versions before it readable, and two
runs that publish the same number at once cannot both succeed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

VERSIONS = "_versions"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published version numbers, in order."""
    fs, p = _path(spark, f"{root}/{VERSIONS}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def current(spark: SparkSession, root: str) -> dict | None:
    """The content of the newest version, or None."""
    found = versions(spark, root)
    if not found:
        return None
    fs, p = _path(spark, f"{root}/{VERSIONS}/{found[-1]:012d}")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def new_folder(root: str) -> str:
    """A fresh data folder under ``root``; it is no version until published."""
    return f"{root.rstrip('/')}/data-{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, content: dict) -> int:
    """Make ``content`` the newest version; raises where another run has just published that number."""
    found = versions(spark, root)
    number = found[-1] + 1 if found else 1
    # written beside, then renamed: a file under its final name is always whole
    fs, part = _path(spark, f"{root}/{VERSIONS}/.{uuid.uuid4().hex}")
    stream = fs.create(part, False)
    stream.write(bytearray(json.dumps(content).encode("utf-8")))
    stream.close()
    _, final = _path(spark, f"{root}/{VERSIONS}/{number:012d}")
    if fs.exists(final) or not fs.rename(part, final):
        fs.delete(part, False)
        raise FileExistsError(f"version {number} of {root} is there already")
    return number


def drop_old(spark: SparkSession, root: str, folders: set[str], keep: int = 2) -> None:
    """Delete versions before the newest ``keep`` and data folders that no remaining version names.

    ``folders`` are those the remaining versions name, as full paths.
    """
    found = versions(spark, root)
    for number in found[:-keep]:
        fs, p = _path(spark, f"{root}/{VERSIONS}/{number:012d}")
        fs.delete(p, False)
    fs, p = _path(spark, root)
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("data-") and not any(f.rstrip("/").endswith("/" + name) for f in folders):
            fs.delete(s.getPath(), True)
