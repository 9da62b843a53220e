"""Operator 5, approximate nearest neighbours: shifted space-filling curves.

Largest inner products become smallest distances by one more coordinate
(``sqrt(M^2 - |x|^2)`` for candidates, 0 for queries scaled to the largest norm M).
Each of several curves projects the vectors to a few random orthogonal
directions, shifts the grid by a random offset, and takes the Hilbert number of
the cell. Queries and candidates are range-partitioned by curve and number;
every range is a cell of about ``CELL`` vectors. A query is compared with the
vectors of the cells within a window around its own, curve by curve, in
blocks; the best of all windows are merged and reranked by exact products.

The window is not a constant: the exact neighbours of a bounded sample of
queries (``SAMPLE_QUERIES``, one scan) tell how far apart, in cells, a query and
its neighbours lie, and the cheapest number of curves and window that
holds ``TARGET`` of them is used. On data without structure the window grows
towards all cells; on clustered data it is narrow.

Equal vectors are one class, searched once; of a class the ``k + 1`` smallest
ids are enough for every query's ``k`` nearest, ties included.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite
components take no part, nor do rows without an id. Vectors of several lengths
have products with their own length only: each length is searched by itself. A query's own row is no candidate;
repeated rows of another id are. Fewer than ``k`` candidates: all of them.
Extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, stage

NEAREST = 20
EVERY = 20
CURVES = 4
DIMS = 8
BITS = 6
CELL = 1024
SAMPLE_QUERIES = 64
SAMPLE_VECTORS = 4096
TARGET = 0.96


def clean(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, vec`` (array of double) of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long"), F.col(column).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    v = v.filter(F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    return v.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))  # -0.0 is 0.0


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert numbers of integer points (n, d), each coordinate below ``2 ** bits``."""
    x = points.T.astype(np.int64).copy()
    d = len(x)
    m = 1 << (bits - 1)
    q = m
    while q > 1:  # undo the excess work of rotations and reflections
        p = q - 1
        for i in range(d):
            high = (x[i] & q) > 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = m
    while q > 1:
        t = np.where((x[d - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


class Curves:
    """Projection, shift and scale of every curve, fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, norm: float, curves: int = CURVES, dims: int = DIMS, bits: int = BITS):
        rng = np.random.default_rng(5)
        self.norm, self.bits = norm, bits
        full = self.lift(sample)
        dims = min(dims, full.shape[1])
        self.axes = [np.linalg.qr(rng.normal(size=(full.shape[1], dims)))[0] for _ in range(curves)]
        self.low, self.step = [], []
        for a in self.axes:
            p = full @ a
            lo, hi = np.quantile(p, [0.005, 0.995], axis=0)
            wide = np.maximum(hi - lo, 1e-12) * 1.25  # a quarter of the range is room for the shift
            self.low.append(lo - wide * 0.2 * rng.random(a.shape[1]))
            self.step.append(wide / (1 << bits))

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        size = np.linalg.norm(x, axis=1)
        if query:
            return np.column_stack([x * (self.norm / size)[:, None], np.zeros(len(x))])
        return np.column_stack([x, np.sqrt(np.maximum(self.norm ** 2 - size ** 2, 0))])

    def keys(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """(curves, n) Hilbert numbers."""
        full = self.lift(x, query)
        out = []
        for a, lo, step in zip(self.axes, self.low, self.step, strict=True):
            cell = np.floor((full @ a - lo) / step)
            out.append(hilbert(np.clip(cell, 0, (1 << self.bits) - 1).astype(np.int64), self.bits))
        return np.array(out)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed the same way whatever the block."""
    return (a * b).sum(axis=1)


#: Values that one step of the exact reranking multiplies.
RERANK_CELLS = 4_000_000


def _best(q: np.ndarray, c: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact products of the k best rows of ``c`` per row of ``q``; ties to smaller ids.

    Every column whose block product could belong to the k best, given the rounding of either sum, is
    multiplied exactly, however many tie.
    """
    k = min(k, len(c))
    s = q @ c.T
    last = -np.partition(-s, k - 1, axis=1)[:, k - 1]
    size = np.abs(q) @ np.abs(c).max(axis=0)  # of any product's terms, summed
    slack = 4 * q.shape[1] * np.finfo(float).eps * size
    out_i, out_s = np.empty((len(q), k), np.int64), np.empty((len(q), k))
    near = s >= (last - slack)[:, None]
    count = near.sum(axis=1)
    at = 0
    while at < len(q):
        most = max(1, RERANK_CELLS // q.shape[1])
        end = at + max(1, int(np.searchsorted(np.cumsum(count[at:]), most, "right")))
        r, j = np.nonzero(near[at:end])
        exact = np.concatenate([_products(q[at + r[x:x + most]], c[j[x:x + most]]) for x in range(0, len(r), most)])
        order = np.lexsort((ids[j], -exact, r))
        first = np.searchsorted(r, np.arange(end - at))
        take = order[first[:, None] + np.arange(k)[None, :]]
        out_i[at:end], out_s[at:end] = ids[j[take]], exact[take]
        at = end
    return out_i, out_s


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """``rep, vec, members``: distinct vectors with their k + 1 smallest ids."""
    keyed = rows.withColumn("h", F.xxhash64("vec"))
    first = keyed.withColumn("r", F.row_number().over(Window.partitionBy("h", "vec").orderBy("vec_id"))).filter(f"r <= {k + 1}")
    return (first.groupBy("h", "vec").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
            .select(F.col("members")[0].alias("rep"), "h", "vec", "members"))


def _sample_neighbours(classes: DataFrame, queries: list, k: int) -> DataFrame:
    """Exact nearest classes of a few queries: each task's best, merged."""
    ids = np.array([r["rep"] for r in queries])
    vecs = np.array([r["vec"] for r in queries])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        best, score = _best(vecs, _matrix(batch.column("vec")), batch.column("rep").to_numpy(), k + 1)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, best.shape[1])), pa.array(best.ravel()), pa.array(score.ravel())],
                                          names=["q", "rep", "score"])
    found = map_batches(classes.select("rep", "vec"), run, "q long, rep long, score double").filter("q <> rep")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "rep"))
    return found.distinct().withColumn("r", rank).filter(f"r <= {k}").select("q", "rep")


def _window(cells: DataFrame, near: DataFrame, curves: int, per_curve: int) -> tuple[int, int]:
    """The cheapest (curves, half window) that holds TARGET of the sample's neighbours."""
    q = cells.filter("kind = 1").select(F.col("rep").alias("q"), "curve", F.col("cell").alias("qc"))
    c = cells.filter("kind = 0").select("rep", "curve", "cell")
    far = (near.join(q, "q").join(c, ["rep", "curve"]).groupBy("q", "rep").pivot("curve", list(range(curves)))
           .agg(F.min(F.abs(F.col("cell") - F.col("qc")))).drop("q", "rep").collect())
    if not far:
        return 1, per_curve
    d = np.minimum.accumulate(np.array([list(r) for r in far], float), axis=1)
    options = []
    for n in range(1, curves + 1):
        h = int(np.sort(d[:, n - 1])[min(len(d) - 1, int(np.ceil(TARGET * len(d))))])
        options.append((n * min(2 * h + 1, per_curve), n, h))
    return min(options)[1:]


def nearest(vectors: DataFrame, k: int = NEAREST, every: int = EVERY, column: str = "embedding",
            cell: int = CELL) -> DataFrame:
    """``query_id, rank, vec_id, score``: for rows whose id is divisible by ``every``, the k nearest other rows."""
    rows = clean(vectors, column).withColumn("d", F.size("vec"))
    lengths = sorted(r["d"] for r in rows.filter(F.pmod("vec_id", F.lit(every)) == 0).select("d").distinct().collect())
    found = [_nearest(rows.filter(F.col("d") == d).drop("d"), k, every, cell) for d in lengths]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return functools.reduce(DataFrame.unionByName, found)


def _nearest(rows: DataFrame, k: int, every: int, cell: int) -> DataFrame:
    """:func:`nearest` among vectors of one length."""
    spark = rows.sparkSession
    classes = stage(_classes(rows, k), "vectors")
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).withColumn("h", F.xxhash64("vec"))
    asked = stage(asked.join(classes.select("h", "vec", "rep"), ["h", "vec"]).select(F.col("vec_id").alias("query_id"), "rep"), "asked")
    queries = classes.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "vec")
    stats = classes.agg(F.count("*").alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    if not stats["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    by_hash = F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(1 << 20))
    sample = (classes.filter(by_hash < -(-2 * SAMPLE_VECTORS * (1 << 20) // stats["n"])).withColumn("o", F.xxhash64("rep", F.lit(3)))
              .orderBy("o", "rep").limit(SAMPLE_VECTORS).select("vec").collect())
    curves = Curves(np.array([r["vec"] for r in sample] or [r["vec"] for r in classes.orderBy("rep").select("vec").limit(1).collect()]),
                    stats["m"] ** 0.5)
    per_curve = max(1, -(-stats["n"] // cell))
    n_curves = len(curves.axes) if per_curve > 1 else 1  # vectors that fit into one cell all meet there

    def place(kind: int):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = curves.keys(_matrix(batch.column("vec")), kind == 1)[:n_curves]
            n = batch.num_rows
            at = np.tile(np.arange(n), n_curves)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(n_curves, dtype=np.int32), n)), pa.array(keys.ravel()),
                 pa.array(np.full(n * n_curves, kind, np.int32)), batch.column("rep").take(pa.array(at)),
                 batch.column("vec").take(pa.array(at))], names=["curve", "key", "kind", "rep", "vec"])
        return run
    schema = "curve int, key long, kind int, rep long, vec array<double>"
    points = (map_batches(classes.select("rep", "vec"), place(0), schema)
              .unionByName(map_batches(queries, place(1), schema)))
    # neighbouring ranges of the curves; a hash of the id cuts runs of equal keys
    ordered = points.repartitionByRange(per_curve * n_curves, "curve", "key", F.xxhash64("rep"))
    cells = stage(ordered.withColumn("cell", F.spark_partition_id()), "cells")
    some = (queries.withColumn("o", F.xxhash64("rep", F.lit(11))).orderBy("o").limit(SAMPLE_QUERIES).select("rep", "vec").collect())
    used, half = _window(cells, _sample_neighbours(classes, some, k), n_curves, per_curve) if some else (1, 0)

    ends = F.broadcast(cells.groupBy("curve").agg(F.min("cell").alias("lo"), F.max("cell").alias("hi")))  # one row per curve
    mine = cells.filter(F.col("curve") < used)
    reach = (mine.filter("kind = 1").join(ends, "curve")
             .withColumn("cell", F.explode(F.sequence(F.greatest(F.col("cell") - half, "lo"), F.least(F.col("cell") + half, "hi")))))
    met = mine.filter("kind = 0").select("cell", "kind", "rep", "vec").unionByName(reach.select("cell", "kind", "rep", "vec"))
    met = met.repartition("cell").sortWithinPartitions("cell", "kind")

    def search(batches):
        now, ids, held = None, [], []
        for batch in batches:
            cell_of = batch.column("cell").to_numpy()
            kind_of = batch.column("kind").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((cell_of[1:] != cell_of[:-1]) | (kind_of[1:] != kind_of[:-1])) + 1, [len(cell_of)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if a == b:
                    continue
                if cell_of[a] != now:
                    now, ids, held = cell_of[a], [], []
                rep, vec = batch.column("rep").slice(a, b - a).to_numpy(), _matrix(batch.column("vec").slice(a, b - a))
                if kind_of[a] == 0:
                    ids.append(rep)
                    held.append(vec)
                elif held:
                    ids, held = [np.concatenate(ids)], [np.concatenate(held)]
                    for x in range(0, len(rep), 512):
                        best, score = _best(vec[x:x + 512], held[0], ids[0], k + 1)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(rep[x:x + 512]), pa.array([r.tobytes() for r in best], pa.binary()),
                             pa.array([r.tobytes() for r in score], pa.binary())], names=["q", "reps", "scores"])

    def merge(batches):
        now, reps, scores = None, [], []

        def flush():
            ids, at = np.unique(np.concatenate(reps), return_index=True)
            s = np.concatenate(scores)[at]
            order = np.lexsort((ids, -s))[:k + 1]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(order), now)), pa.array(ids[order]), pa.array(s[order])],
                                              names=["q", "rep", "score"])
        for batch in batches:
            for q, r, s in zip(*(batch.column(c).to_pylist() for c in ("q", "reps", "scores")), strict=True):
                if q != now and reps:
                    yield flush()
                    reps, scores = [], []
                now = q
                reps.append(np.frombuffer(r, np.int64))
                scores.append(np.frombuffer(s, float))
        if reps:
            yield flush()
    best = (met.mapInArrow(search, "q long, reps binary, scores binary").repartition("q").sortWithinPartitions("q")
            .mapInArrow(merge, "q long, rep long, score double"))
    # classes to ids: k + 1 of them serve every query of the class, its own row left out
    ids = best.join(classes.select("rep", "members"), "rep").select("q", "score", F.explode("members").alias("vec_id"))
    order = [F.desc("score"), "vec_id"]
    ids = ids.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(f"r <= {k + 1}").drop("r")
    out = asked.join(ids, asked["rep"] == ids["q"]).filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return out.withColumn("rank", rank).filter(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
