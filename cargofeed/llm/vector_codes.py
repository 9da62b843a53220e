"""Operator 11, vector code compression: product codes by a trie over distinct parts.

Components become integers, ``floor(1024 * x)``; a vector is cut into ``PARTS``
equal consecutive parts, each coded by the nearest of ``ENTRIES`` codebook
entries of its position. The distinct parts of every position are counted once
(combined map-side, so a vector that fills a third of the table is one row) and
kept sorted lexicographically. Each round walks them as a trie: a
node is a common prefix of dimensions and carries one vector of
distances to all entries, summed up to there, which its children share; a
leaf takes the argmin and adds its part, weighted by its count, to that
entry's sum. Siblings are visited in blocks of ``BLOCK`` consecutive leaves, so
a task holds two ``BLOCK x ENTRIES`` arrays whatever its input. Only
the sums (``PARTS * ENTRIES`` rows) reach the driver. The last assignment goes
over the rows themselves, each batch a trie of its own; no row is shuffled for it.

All arithmetic is on integers, so results depend on no order or partitioning.

Defined cases: vectors that are NULL or hold NULL or non-finite components are
dropped. A vector of no components is kept and has code ``00`` per part and
error 0 beside others. Lengths that differ or are no multiple of ``PARTS`` count
as filled up with zeros to the longest length, rounded up. Integers beyond the
bound within which every squared distance fits a long are held at it (2^27 for 64
dimensions, thus components beyond 131,072). Repeated rows count once per row;
ties among the first ids go by the vector, NULL ids come last; fewer
rows than entries make a smaller codebook. NULL labels are one label. Extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, stage

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Leaves of the trie visited at a time.
BLOCK = 256
#: A label with this share of the rows has its sum broadcast (at most ``1 / HEAVY`` labels).
HEAVY = 0.001


def finite(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is not NULL and holds finite components only."""
    return vectors.filter(F.col(column).isNotNull() & F.forall(
        F.col(column), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf")))))


def integers(vectors: DataFrame, column: str, width: int) -> DataFrame:
    """``x``: the vector as ``width`` integers."""
    bound = float(1 << min(30, (60 - max(1, width - 1).bit_length()) // 2))
    x = F.transform(F.col(column).cast("array<double>"),
                    lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-bound)), F.lit(bound))).cast("int"))
    filled = F.concat(x, F.array_repeat(F.lit(0), F.lit(width) - F.size(x)))
    return vectors.withColumn("x", filled)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def prefix_depths(parts: np.ndarray) -> np.ndarray:
    """Length of the prefix that each (sorted) row shares with the row before; 0 for the first."""
    differs = parts[1:] != parts[:-1]
    depth = np.where(differs.any(axis=1), differs.argmax(axis=1), parts.shape[1])
    return np.concatenate([[0], depth]) if len(parts) else np.zeros(0, np.int64)


def walk(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (the lowest of equals) and squared distance of lexicographically sorted parts."""
    n, width = parts.shape
    near, far = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not width or not n:
        return near, far
    span = int(max(parts.max(), entries.max())) - int(min(parts.min(), entries.min()))
    kind = np.int32 if span * span * width < 2 ** 31 else np.int64  # exact in either
    entry = np.ascontiguousarray(entries.T.astype(kind))
    depth = prefix_depths(parts)
    for at in range(0, n, BLOCK):
        rows, shared = parts[at:at + BLOCK].astype(kind), depth[at:at + BLOCK].copy()
        shared[0] = 0  # a block starts at the root again
        nodes = np.zeros(1, np.int64)  # first row of every node of the level above
        sums = np.zeros((1, len(entries)), kind)
        step = np.empty((len(rows), len(entries)), kind)
        for k in range(width):
            first = np.flatnonzero(shared <= k)
            if len(first) != len(nodes):  # some nodes branch: children start from their parent's sums
                sums = sums[np.searchsorted(nodes, first, side="right") - 1]
                nodes = first
            buf = step[:len(first)]
            np.subtract(rows[first, k][:, None], entry[k][None, :], out=buf)
            np.multiply(buf, buf, out=buf)
            sums += buf
        leaf = np.searchsorted(nodes, np.arange(len(rows)), side="right") - 1
        best = sums.argmin(axis=1)
        near[at:at + BLOCK] = best[leaf]
        far[at:at + BLOCK] = sums[np.arange(len(best)), best][leaf]
    return near, far


def _sums(parts: np.ndarray, weight: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries met, with the weighted sums and counts of their parts."""
    order = np.argsort(near, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], near[order][1:] != near[order][:-1]]))
    weighted = parts.astype(np.int64)[order] * weight[order][:, None]
    return near[order][starts], np.add.reduceat(weighted, starts, axis=0), np.add.reduceat(weight[order], starts)


def distinct_parts(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """``part, x, weight``: every position's distinct parts, sorted within the partitions."""
    cut = F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.slice("x", p * width + 1, width).alias("x")) for p in range(parts)]))
    return (rows.select(cut.alias("p")).select("p.part", "p.x").groupBy("part", "x").agg(F.count("*").alias("weight"))
            .sortWithinPartitions("part", "x"))


def _round(counted: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, every used entry to the floor of its mean."""
    n_parts, _, width = books.shape

    def run(batches):
        totals: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            part = batch.column("part").to_numpy()
            x, weight = matrix(batch.column("x"), width), batch.column("weight").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                p = int(part[a])
                near, _ = walk(x[a:b], books[p])
                entry, total, count = _sums(x[a:b], weight[a:b], near)
                if p not in totals:
                    totals[p] = np.zeros(books.shape[1:], np.int64), np.zeros(books.shape[1], np.int64)
                totals[p][0][entry] += total
                totals[p][1][entry] += count
        for p, (total, count) in totals.items():
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)),
                 pa.array(total[used].tolist(), pa.list_(pa.int64())), pa.array(count[used])], names=["part", "entry", "total", "n"])
    found = counted.mapInArrow(run, "part int, entry int, total array<long>, n long").groupBy("part", "entry")
    totals = found.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[j]) for j in range(width)]).alias("total")).collect()
    out = books.copy()
    for r in totals:  # at most PARTS * ENTRIES rows
        out[r["part"], r["entry"]] = np.array(r["total"], np.int64) // r["n"]
    return out


def train(rows: DataFrame, parts: int, width: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width) of ``rows(vec_id, x)``."""
    first = rows.select("vec_id", "x").orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    if len(first) and width:
        counted = stage(distinct_parts(rows, parts, width), "parts")
        for _ in range(rounds):
            books = _round(counted, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of every row of ``rows(vec_id, label, x)``."""
    n_parts, _, width = books.shape

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        x = matrix(batch.column("x"), n_parts * width) if width else np.zeros((n, 0), np.int32)
        codes, error = np.empty((n, n_parts), np.uint8), np.zeros(n, np.int64)
        for p in range(n_parts):
            part = x[:, p * width:(p + 1) * width]
            order = np.lexsort(part.T[::-1]) if width else np.arange(n)
            near, far = walk(part[order], books[p])
            codes[order, p] = near
            error[order] += far
        return pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)],
            names=["vec_id", "label", "code", "error"])
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return map_batches(rows.select("vec_id", "label", "x"), run, schema)


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: labels with many rows by broadcast of their sums, the others by their key."""
    sums = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "labels")
    bound = (sums.agg(F.sum("n")).first()[0] or 0) * HEAVY
    named = sums.withColumnRenamed("label", "__label")
    same = F.col("label").eqNullSafe(F.col("__label"))
    heavy = F.broadcast(named.filter(F.col("n") > F.lit(bound)))  # fewer than 1 / HEAVY rows
    out = coded.join(heavy, same)
    rest = coded.join(heavy.select("__label"), same, "left_anti").join(named.filter(F.col("n") <= F.lit(bound)), same)
    return out.unionByName(rest).drop("__label", "n")


def compress(vectors: DataFrame, column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept row."""
    kept = finite(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col(column).alias("v")), "v")
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = math.ceil(longest / parts)
    rows = integers(kept, "v", width * parts).select("vec_id", "label", "x")
    books = train(rows, parts, width, entries, rounds)
    coded = stage(encode(rows, books), "codes")
    return _with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _oracle(rounds: int = ROUNDS) -> str:
    distance = "list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i])))"

    def nearest(r):
        return f"""
a{r} AS (
  SELECT part, rn, arg_min(entry, d * {ENTRIES} + entry) AS entry, min(d) AS d
  FROM (SELECT p.part, p.rn, c.entry, {distance} AS d FROM p JOIN c{r} c USING (part)) GROUP BY part, rn),"""

    def update(r):
        return f"""
m{r} AS (
  SELECT part, entry, i, sum(x[i]) AS s, count(*) AS n
  FROM p JOIN a{r} USING (part, rn), range(1, {64 // PARTS + 1}) t(i) GROUP BY part, entry, i),
c{r + 1} AS (
  SELECT c.part, c.entry, coalesce(u.x, c.x) AS x
  FROM c{r} c LEFT JOIN (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x
                         FROM m{r} GROUP BY part, entry) u USING (part, entry)),"""
    return f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS v,
         row_number() OVER (ORDER BY vec_id) - 1 AS rn
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS (
  SELECT rn, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS x FROM k, range({PARTS}) t(part)),
c0 AS (SELECT part, rn AS entry, x FROM p WHERE rn < {ENTRIES}),""" + "".join(nearest(r) + update(r) for r in range(rounds)) + nearest(rounds) + f"""
b AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds}),
coded AS (
  SELECT rn, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY rn)
SELECT k.vec_id, coded.code, coded.error, CAST(sum(coded.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, b.codebooks_sha256
FROM k JOIN coded USING (rn), b
"""


#: Vectors of 64 components, as in the test tables.
ORACLE_SQL = _oracle()
