"""Operator 6, packing: shortest-pack-first over the length histogram.

Texts are tokenized where they are (one end token each) and cut into pieces
of ``width`` tokens and a rest; only one narrow row per piece goes on. The
histogram of piece lengths has at most ``width`` rows, whatever the corpus, and
is packed on the driver: lengths are placed longest first into the shortest
open pack that has room, in bulk, by updating counts of packing patterns. A
step either uses up a length or a pattern, so there are at most two patterns
per length, each a list of at most ``sqrt(2 * width)`` distinct lengths.

Patterns are joined back by rank: the pieces of a length are numbered in
parallel (a running number within a hash slice of the length, plus the sizes
of the slices before it), and each rank has its sequence and offset by
arithmetic on the slot table.

Defined cases: NULL counts as empty text (one piece, the end token alone);
repeated rows are packed once per row; extra columns are ignored; an empty
table gives an empty table. Every id is in exactly one piece.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import default_vocabulary, shared_encoder
from .common import id_text, map_batches, stage

WIDTH = 4096
END_ID = 2
#: About as many pieces of one length are numbered by one task.
SLICE_ROWS = 200_000
#: Bytes of texts encoded at a time, and words kept, by a worker that has to save memory.
LEAN_BYTES = 1 << 20
LEAN_WORDS = 150_000


def pack_histogram(histogram: dict[int, int], width: int = WIDTH) -> list[tuple[list[int], int]]:
    """Shortest-pack-first: ``[(lengths of a pattern, number of sequences)]``."""
    packs: dict[int, list[tuple[tuple, int]]] = defaultdict(list)  # by total: (pattern, count)
    totals: list[int] = []  # heap of totals in use; emptied ones are skipped
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while totals and not packs[totals[0]]:
                heapq.heappop(totals)
            if totals and totals[0] + length <= width:
                total = totals[0]
                pattern, n = packs[total].pop()
                used = min(n, left)
                if used < n:
                    packs[total].append((pattern, n - used))
            else:
                total, pattern, used = 0, None, left
            if not packs[total + length]:
                heapq.heappush(totals, total + length)
            packs[total + length].append(((pattern, length), used))
            left -= used
    out = []
    for entries in packs.values():
        for pattern, n in entries:
            lengths = []
            while pattern is not None:
                pattern, x = pattern
                lengths.append(x)
            out.append((lengths[::-1], n))
    out.sort(key=lambda p: (-sum(p[0]), p[0]))
    return out


def slots(patterns: list[tuple[list[int], int]]) -> np.ndarray:
    """Rows ``length, lowest rank, first sequence, sequences, offset``, sorted by length and rank.

    Rank r of a length, k = r - lowest rank, lies in sequence
    ``first + k % sequences`` at ``offset + length * (k // sequences)``.
    """
    rows, used, first = [], defaultdict(int), 0
    for lengths, n in patterns:
        at, i = 0, 0
        while i < len(lengths):
            x, j = lengths[i], i
            while j < len(lengths) and lengths[j] == x:
                j += 1
            rows.append((x, used[x], first, n, at))
            used[x] += n * (j - i)
            at, i = at + x * (j - i), j
        first += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, path: str | None = None, width: int = WIDTH, end_id: int = END_ID,
           lean: bool = False) -> DataFrame:
    """Each document's ids (and the end token) cut into pieces of ``width`` and a rest.

    ``lean``: workers take a batch in parts of about ``LEAN_BYTES`` and keep ``LEAN_WORDS`` words,
    which costs CPU time and saves more than 100 MB a worker.
    """
    shared = shared_encoder(docs, path or default_vocabulary())

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if lean:
            shared.value.most_words = LEAN_WORDS
        rows = max(1, batch.num_rows * LEAN_BYTES // max(1, batch.nbytes)) if lean else batch.num_rows
        for at in range(0, batch.num_rows, rows):
            yield cut(batch.slice(at, rows))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, bounds = shared.value.encode_ids(batch.column("text").to_pylist())
        n = batch.num_rows
        # every text's ids with its end token behind them, in one buffer
        size = np.diff(bounds) + 1
        first = np.cumsum(size) - size
        ids, text = np.empty(len(flat) + n, "<u4"), np.ones(len(flat) + n, bool)
        text[first + size - 1] = False
        ids[first + size - 1] = end_id
        ids[text] = flat
        cuts = -(-size // width)
        doc = np.repeat(np.arange(n), cuts)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * width
        length = np.minimum(width, size[doc] - start)
        raw = memoryview(ids).cast("B")
        crc = [zlib.crc32(raw[4 * a:4 * (a + k)]) for a, k in zip((first[doc] + start).tolist(), length.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(doc)), *(pa.array(c, pa.int64()) for c in (start, length, crc, size[doc]))],
            names=[f.split()[0] for f in PIECES.split(", ")])
    return map_batches(id_text(docs), run, PIECES)


def pack(cut: DataFrame, width: int = WIDTH) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (any rows with a ``length`` up to ``width``)."""
    spark = cut.sparkSession
    cut = stage(cut, "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if histogram and not 0 < min(histogram) <= max(histogram) <= width:
        raise ValueError(f"piece lengths must lie between 1 and {width}")
    plan = spark.sparkContext.broadcast(slots(pack_histogram(histogram, width)))
    # hash slices of a length, so that no task numbers all pieces of a common one
    ways = max(1, -(-max(histogram.values(), default=1) // SLICE_ROWS))
    sliced = cut.withColumn("__slice", F.pmod(F.xxhash64("doc_id", "start"), F.lit(ways)))
    before = (sliced.groupBy("length", "__slice").agg(F.count("*").alias("n"))
              .withColumn("__before", F.sum("n").over(Window.partitionBy("length").orderBy("__slice")) - F.col("n"))
              .drop("n"))
    number = F.row_number().over(Window.partitionBy("length", "__slice").orderBy("doc_id", "start"))
    ranked = (sliced.withColumn("__number", number).join(before, ["length", "__slice"])
              .withColumn("__rank", F.col("__number") - 1 + F.col("__before"))
              .select(*cut.columns, "__rank"))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = plan.value
        length, rank = batch.column("length").to_numpy(), batch.column("__rank").to_numpy()
        row = table[_last_at_most(table, length, rank)]
        k = rank - row[:, 1]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(row[:, 2] + k % row[:, 3]), pa.array(row[:, 4] + length * (k // row[:, 3]))],
            names=[*batch.schema.names[:-1], "sequence_id", "offset"])
    schema = ", ".join(f"`{n}` {t}" for n, t in cut.dtypes)
    return map_batches(ranked, place, schema + ", sequence_id long, offset long")


def _last_at_most(table: np.ndarray, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Row of the slot table that holds each (length, rank)."""
    lo = np.searchsorted(table[:, 0], length, "left")
    hi = np.searchsorted(table[:, 0], length, "right") - 1
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        up = table[mid, 1] <= rank
        lo, hi = np.where(up, mid, lo), np.where(up, hi, mid - 1)
    return lo


def pack_documents(docs: DataFrame, path: str | None = None, width: int = WIDTH, lean: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece (``lean``: see :func:`pieces`)."""
    return pack(pieces(docs, path, width, lean=lean), width)
