"""Operator 13, embedding whitening: bit-sliced scatter.

Entries become integers ``floor(64 * c) + 1000000``. The fit list, each distinct
vector once, is made by a map-side combined grouping and written. Its exact
sums and cross-products come from bit planes: a block of rows, shifted by
its smallest entry per dimension, is turned into one bitmap per dimension and
bit (a row a bit, 64 rows a word); the population count of two bitmaps'
AND, weighted by both bits, sums to the cross-product of two dimensions. Each
task adds up its blocks as Python integers, Spark adds the tasks (numbers
travel in limbs of 30 bits, so no size overflows), and the driver gets one number per
pair of dimensions. ``n * cross - S * S'`` is the centred scatter times n, an
exact integer; its division by ``n^2`` is the first rounding before ``eigh`` (:func:`eigen`).

Rows are then projected one by one from ``n * x - S``, which is exact too.

Defined cases: vectors that are NULL or hold NULL or non-finite entries are
dropped; a vector without entries gives no row. Vectors of several lengths are
fitted length by length, each with its own n, in one pass; ``identity_error``
is the largest of all. Entries beyond 2^62 / 64 are held there. Repeated
rows each get their rows, a repeated or NULL ``vec_id`` too, and count once in the fit.
Components of no variance (their eigenvalue is no more than rounding) have ``whitened``
NULL; ``explained`` is NULL where the trace is 0. ``deviation`` is NULL where
it passes a long; ``deviation_text`` holds it in decimal digits always. Extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stage
from .vector_codes import finite

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Rows of a block (fewer where vectors are wide: a block has at most ``CELLS`` entries, or 64 rows).
BLOCK = 8192
CELLS = 1 << 21
#: Bits of a limb, and limbs of a number: 180 bits are enough for 2^40 rows of 62-bit entries.
LIMB, LIMBS = 30, 7
_BOUND = float(1 << 62)


def entries(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, x`` (array of long) of the remaining rows."""
    kept = finite(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("v")), "v")
    x = F.transform(F.col("v").cast("array<double>"),
                    lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-_BOUND)), F.lit(_BOUND))) + F.lit(OFFSET).cast("long"))
    return kept.select("vec_id", x.alias("x")).filter(F.size("x") > 0)


def bit_planes(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bitmaps (planes, words) of unsigned rows, with each plane's dimension and bit."""
    rows, dims = u.shape
    words = -(-rows // 64)
    top = u.max(axis=0) if rows else np.zeros(dims, np.uint64)
    dim, bit, planes = [], [], []
    for i in range(dims):
        for b in range(int(top[i]).bit_length()):
            on = np.zeros(words * 64, np.uint8)
            on[:rows] = (u[:, i] >> np.uint64(b)) & np.uint64(1)
            planes.append(np.packbits(on).view(np.uint64))
            dim.append(i)
            bit.append(b)
    return (np.array(planes, np.uint64).reshape(len(planes), words), np.array(dim, np.int64), bit)


def block_products(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums (dims) and cross-products (dims, dims) of unsigned rows, as Python integers."""
    dims = u.shape[1]
    planes, dim, bit = bit_planes(u)
    sums, cross = np.zeros(dims, object), np.zeros((dims, dims), object)
    if not len(planes):
        return sums, cross
    counts = np.zeros((len(planes), len(planes)), np.int64)
    for p in range(len(planes)):
        counts[p, p:] = np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)
    counts = np.triu(counts) + np.triu(counts, 1).T
    # weights 2^bit: in 64 bits where that is exact, else as Python integers
    small = 2 * (max(bit) + 1) + len(u).bit_length() < 62
    weight = np.array([1 << b for b in bit], np.int64 if small else object)
    starts = np.flatnonzero(np.concatenate([[True], dim[1:] != dim[:-1]]))
    weighted = np.add.reduceat(np.add.reduceat(counts * weight[:, None] * weight[None, :], starts, axis=0), starts, axis=1)
    used = dim[starts]
    cross[np.ix_(used, used)] = weighted.astype(object)
    sums[used] = np.add.reduceat(np.diagonal(counts) * weight, starts).astype(object)  # a plane with itself: its own count
    return sums, cross


class Scatter:
    """Running count, sums and cross-products of vectors of one length, exact."""

    def __init__(self, dims: int):
        self.n, self.sums, self.cross = 0, np.zeros(dims, object), np.zeros((dims, dims), object)

    def add(self, x: np.ndarray) -> None:
        low = x.min(axis=0)
        base = np.array(low.tolist(), object)
        sums, cross = block_products(x.astype(np.uint64) - low.astype(np.uint64))  # modulo 2^64, so a 63-bit range is safe
        m = len(x)
        shift = np.outer(base, sums)
        self.n += m
        self.sums += sums + m * base
        self.cross += cross + shift + shift.T + m * np.outer(base, base)


def _limbs(v: int) -> list[int]:
    out = []
    for _ in range(LIMBS - 1):
        out.append(v & ((1 << LIMB) - 1))
        v >>= LIMB
    return [*out, v]


SCATTER = "d int, i int, j int, limbs array<long>"


def scatter(fit: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """By vector length: ``(n, sums, cross-products)`` of the rows of ``fit(d, x)``, exact."""
    def run(batches):
        by: dict[int, Scatter] = {}
        held: dict[int, list[np.ndarray]] = {}

        def close(d):
            rows = held.pop(d, [])
            if rows:
                by.setdefault(d, Scatter(d)).add(np.concatenate(rows))
        for batch in batches:
            size = batch.column("d").to_numpy()
            for d in np.unique(size).tolist():
                x = batch.column("x").filter(pa.array(size == d)).flatten().to_numpy().reshape(-1, d)
                held.setdefault(d, []).append(x)
                if sum(map(len, held[d])) >= max(64, min(BLOCK, CELLS // d)):
                    close(d)
        for d in list(held):
            close(d)
        for d, s in by.items():
            i, j = np.triu_indices(d)
            numbers = [s.n, *s.sums.tolist(), *s.cross[i, j].tolist()]
            first = np.concatenate([[-1], np.full(d, -1), i])
            second = np.concatenate([[-1], np.arange(d), j])
            for at in range(0, len(numbers), 4096):
                part = numbers[at:at + 4096]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), d, np.int32)), pa.array(first[at:at + 4096].astype(np.int32)),
                     pa.array(second[at:at + 4096].astype(np.int32)), pa.array([_limbs(int(v)) for v in part], pa.list_(pa.int64()))],
                    names=["d", "i", "j", "limbs"])
    rows = (fit.select("d", "x").mapInArrow(run, SCATTER).groupBy("d", "i", "j")
            .agg(*[F.sum(F.col("limbs")[k]).alias(f"l{k}") for k in range(LIMBS)]).collect())  # one row per pair of dimensions
    out: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
    for d in {r["d"] for r in rows}:
        n, sums, cross = 0, np.zeros(d, object), np.zeros((d, d), object)
        for r in rows:
            if r["d"] == d:
                v = sum(r[f"l{k}"] << (LIMB * k) for k in range(LIMBS))
                if r["j"] < 0:
                    n = v
                elif r["i"] < 0:
                    sums[r["j"]] = v
                else:
                    cross[r["i"], r["j"]] = cross[r["j"], r["i"]] = v
        out[d] = n, sums, cross
    return out


#: Eigenvalues above this share of the largest are taken from one ``eigh``; the rest from one on their own subspace.
GRADE = 1e-6
#: Share of the largest eigenvalue below which one is rounding (of the bases' rounding, squared).
NOISE = 1e-26


def _ratio(a: np.ndarray, b: int) -> np.ndarray:
    """Integers over an integer, each correctly rounded."""
    return np.array([[v / b for v in row] for row in a.tolist()], float).reshape(a.shape)


def eigen(centred: np.ndarray, square: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and unit eigenvectors of ``centred / square`` (integers).

    ``eigh`` is exact to a share of the largest eigenvalue, so of values far below it little is left. These are
    solved again on the subspace that the large ones leave, whose covariance is computed with integers first.
    """
    d = len(centred)
    wanted = min(wanted, d)
    values, axes, basis = np.zeros(0), np.zeros((d, 0)), np.eye(d)
    cov = _ratio(centred, square)
    while len(values) < wanted:
        w, u = np.linalg.eigh((cov + cov.T) / 2)
        w, q = w[::-1], basis @ u[:, ::-1]
        top = max(w[0], 0.0)
        if top <= NOISE * (values[0] if len(values) else top):
            values = np.concatenate([values, np.zeros(wanted - len(values))])
            axes = np.column_stack([axes, q[:, :len(values) - axes.shape[1]]])
            break
        sure = int((w > GRADE * top).sum())
        values, axes = np.concatenate([values, w[:sure]]), np.column_stack([axes, q[:, :sure]])
        if len(values) < wanted:
            whole, _ = np.linalg.qr(np.column_stack([axes, q[:, sure:]]))
            basis = whole[:, axes.shape[1]:]
            fixed = np.array([[int(v * 2.0 ** 60) for v in row] for row in basis.tolist()], object)
            cov = _ratio(fixed.T.dot(centred).dot(fixed), square << 120)
    return values[:wanted], axes[:, :wanted]


class Whitener:
    """Eigenvectors of one length's covariance, by falling eigenvalue."""

    def __init__(self, n: int, sums: np.ndarray, cross: np.ndarray, components: int = COMPONENTS):
        self.n, self.sums = n, sums
        centred = n * cross - np.outer(sums, sums)  # integers
        self.values, self.axes = eigen(centred, n * n, components)
        self.trace = sum(np.diagonal(centred).tolist()) / (n * n)
        self.real = self.values > NOISE * max(self.values, default=0)

    @property
    def explained(self) -> list[float | None]:
        return [v / self.trace if self.trace else None for v in self.values.tolist()]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: in 64 bits where every square sum fits, else Python integers."""
        s = self.sums.tolist()
        reach = max((max(abs(self.n * int(hi) - t), abs(self.n * int(lo) - t))
                     for hi, lo, t in zip(x.max(axis=0), x.min(axis=0), s, strict=True)), default=0)
        if reach * reach * x.shape[1] < 2 ** 62:
            # wraps in between, but the difference fits
            return (x.astype(np.uint64) * np.uint64(self.n) - np.array([t % 2 ** 64 for t in s], np.uint64)).view(np.int64)
        return x.astype(object) * self.n - np.array(s, object)

    def project(self, centred: np.ndarray) -> np.ndarray:
        """Whitened rows; components of no variance are NaN."""
        y = (centred / self.n).astype(float) @ self.axes  # each entry rounded once
        return np.where(self.real, y / np.sqrt(np.where(self.real, self.values, 1)), np.nan)


def identity_error(fit: DataFrame, models: dict[int, Whitener]) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, measured on its rows."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            size = batch.column("d").to_numpy()
            for d in np.unique(size).tolist():
                x = batch.column("x").filter(pa.array(size == d)).flatten().to_numpy().reshape(-1, d)
                w = models[d].project(models[d].centred(x))[:, models[d].real]
                both = np.concatenate([w.T @ w, w.sum(axis=0)[None, :]])
                total[d] = total[d] + both if d in total else both
        for d, t in total.items():
            i, j = np.indices(t.shape)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(t.size, d, np.int32)), pa.array(i.ravel().astype(np.int32)),
                                              pa.array(j.ravel().astype(np.int32)), pa.array(t.ravel())], names=["d", "i", "j", "v"])
    rows = fit.select("d", "x").mapInArrow(run, "d int, i int, j int, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v")).collect()
    worst = 0.0
    for d in {r["d"] for r in rows}:
        k, n = int(models[d].real.sum()), models[d].n
        t = np.zeros((k + 1, k))
        for r in rows:
            if r["d"] == d:
                t[r["i"], r["j"]] = r["v"]
        mean = t[k] / n
        worst = max(worst, float(np.abs(t[:k] / n - np.outer(mean, mean) - np.eye(k)).max(initial=0)))
    return worst


WHITENED = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
            "deviation_text string")


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component."""
    rows = entries(vectors, column).withColumn("d", F.size("x"))
    fit = stage(rows.select("d", "x").groupBy("d", "x").agg(F.lit(1).alias("one")).select("d", "x"), "fit")
    models = {d: Whitener(*found, components) for d, found in scatter(fit).items()}
    error = identity_error(fit, models) if models else 0.0

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        size, out = batch.column("d").to_numpy(), []
        for d in np.unique(size).tolist():
            here = pa.array(size == d)
            model, x = models[d], batch.column("x").filter(here).flatten().to_numpy().reshape(-1, d)
            c = model.centred(x)
            white, deviation = model.project(c), (c * c).sum(axis=1).tolist()
            k, rep = white.shape[1], lambda a: np.repeat(a, white.shape[1])  # noqa: B023
            at = rep(np.arange(len(x)))
            out.append(pa.RecordBatch.from_arrays([
                batch.column("vec_id").filter(here).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(at), model.n, np.int64)),
                pa.array([int(v) if v < 2 ** 63 else None for v in deviation], pa.int64()).take(pa.array(at)),
                pa.array(white.ravel(), mask=np.isnan(white).ravel()), pa.array(model.explained * len(x), pa.float64()),
                pa.array(np.full(len(at), error)), pa.array([str(int(v)) for v in deviation], pa.string()).take(pa.array(at))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_text"]))
        yield from out
    return map_batches(rows.select("vec_id", "d", "x"), run, WHITENED)
