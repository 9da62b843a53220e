"""Join helpers: size-checked broadcast and key-set restriction.

Broadcasting is only safe for a side whose size is *known*, not estimated.
Rows and bytes of a side are counted first and only then is a broadcast hinted; beyond the bound a key set is
sent as a Bloom filter, whose size follows from the count, and the join itself is left to the
shuffle strategies (sort-merge, with AQE skew splitting and AQE's own
measured broadcast conversion).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Upper bounds of a hinted broadcast: rows, and bytes of their values as text
#: (a row's hash table entry is allowed for with ``ROW_BYTES``).
DIMENSION_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 << 20
ROW_BYTES = 32

#: Bits of a Bloom filter per key, and of one block (eight words of 64 bits).
BLOOM_BITS = 12
BLOCK_WORDS = 8
#: Most blocks that are broadcast: 2M rows of nine longs, enough for 85M keys.
BLOOM_MAX_BLOCKS = 2_000_000

#: Up to so many keys are also named in the scan's filter.
PUSHED_KEYS = 1000


def _size(df: DataFrame) -> list[Column]:
    """Aggregates: rows, and bytes of all values as text."""
    width = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    total = reduce(lambda a, b: a + b, width, F.lit(ROW_BYTES))
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(total.cast("long")), F.lit(0)).alias("bytes")]


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes (partial
    sums per task, nothing is funnelled into one)."""
    r = df.agg(*_size(df)).first()
    return r["n"] <= max_rows and r["bytes"] <= max_bytes


@dataclass(frozen=True)
class KeySize:
    """Rows and bytes of a key set, and the least and greatest value of each of its columns."""

    n: int
    bytes: int
    ends: list[tuple]

    def within(self, max_rows: int) -> bool:
        return self.n <= max_rows and self.bytes <= BROADCAST_MAX_BYTES


def key_size(keys: DataFrame, cols: Sequence[str]) -> KeySize:
    """The size of the key columns ``cols``, in one scan."""
    k = keys.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(cols)])
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in k.columns for f in (F.min, F.max)]
    r = k.agg(*_size(k), *ends).first()
    return KeySize(r["n"], r["bytes"], [(r[f"min_{c}"], r[f"max_{c}"]) for c in k.columns])


def broadcast_if_bounded(df: DataFrame, max_rows: int = DIMENSION_MAX_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when its size is proven within the bounds; else ``df``."""
    if has_at_most(df, max_rows):
        return F.broadcast(df)
    return df


def broadcast_all_if_bounded(dfs: Sequence[DataFrame],
                             max_rows: int = DIMENSION_MAX_ROWS) -> list[DataFrame]:
    """``broadcast_if_bounded`` for several sides with one bounded job.

    The sides are counted together, so proving the bounds of all dimension
    tables of a plan costs one short job instead of one per table.
    """
    if not dfs:
        return []
    tagged = [d.groupBy().agg(F.lit(i).alias("__side"), *_size(d)) for i, d in enumerate(dfs)]
    found = {r["__side"]: r for r in reduce(lambda a, b: a.unionByName(b), tagged).collect()}
    return [F.broadcast(d) if found[i]["n"] <= max_rows and found[i]["bytes"] <= BROADCAST_MAX_BYTES else d
            for i, d in enumerate(dfs)]


def restrict_to_keys(df: DataFrame, keys: DataFrame, on: str | list[str],
                     key_cols: str | list[str] | None = None) -> DataFrame:
    """Left-semi join: rows of ``df`` whose key occurs in ``keys``.

    A semi join never multiplies rows, so it can shrink the input of an
    aggregation grouped by the same key without changing its result.
    """
    left = [on] if isinstance(on, str) else list(on)
    right = left if key_cols is None else ([key_cols] if isinstance(key_cols, str) else list(key_cols))
    k = keys.select(*[F.col(r).alias(f"__k{i}") for i, r in enumerate(right)])
    cond = [df[l] == k[f"__k{i}"] for i, l in enumerate(left)]
    return df.join(k, cond, "left_semi")


def cut_to_keys(df: DataFrame, keys: DataFrame, on: Sequence[str], key_cols: Sequence[str],
                max_rows: int = DIMENSION_MAX_ROWS,
                proven: bool | None = None, exact: bool = True, size: KeySize | None = None) -> DataFrame:
    """Cut a history-wide ``df`` to the rows whose ``on`` columns match
    ``key_cols`` of some row of ``keys`` (a small driving set, e.g. the keys
    of one load window).

    The count of ``keys`` chooses how, never whether. Few keys (rows and bytes counted):
    a left-semi join against the broadcast key set; ``df`` is filtered inside
    its scan stage and never shuffled. More keys: ``df`` is first filtered in its scan stage by a
    broadcast Bloom filter of the keys, about a hundredth of their size, and what
    passes goes through an exact shuffled semi join. Beyond ``BLOOM_MAX_BLOCKS``: the
    shuffled semi join alone. The keys' least and greatest value go into the scan's filter, and up to
    ``PUSHED_KEYS`` values of a single key column as well, so that row groups, files and
    buckets that cannot hold a key are not read. Callers use it only where the following join
    would drop the non-matching rows anyway. ``proven`` passes a bound
    already established for ``keys`` (skips the count when true), ``size`` what :func:`key_size`
    found in them. ``exact=False`` lets
    rows without a match pass where many keys would need the shuffled semi join: only the
    Bloom filter is applied then, or nothing beyond ``BLOOM_MAX_BLOCKS``, so ``df`` is never
    shuffled or sorted for the cut and keeps the partitioning of its storage. The caller's
    own join drops those rows.
    """
    k = keys.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(key_cols)])
    if proven is None:
        size = size or key_size(k, k.columns)
        df = _skip_files(df, k, on, size)
        proven, n = size.within(max_rows), size.n
    else:
        n = None if proven else k.count()
    cond = reduce(lambda a, b: a & b, [df[o] == k[f"__k{i}"] for i, o in enumerate(on)])
    if proven:
        return df.join(F.broadcast(k), cond, "left_semi")
    if -(-n * BLOOM_BITS // (64 * BLOCK_WORDS)) <= BLOOM_MAX_BLOCKS:
        passed = bloom_cut(df, k, on, k.columns, n)
        if not exact:
            return passed
        cond = reduce(lambda a, b: a & b, [passed[o] == k[f"__k{i}"] for i, o in enumerate(on)])
        return passed.join(k, cond, "left_semi")
    return df.join(k, cond, "left_semi") if exact else df


def _skip_files(df: DataFrame, k: DataFrame, on: Sequence[str], size: KeySize) -> DataFrame:
    """Filters that the scan can check against its statistics; the semi join decides exactly."""
    for o, (least, most) in zip(on, size.ends, strict=True):
        if least is not None:
            df = df.filter((F.col(o) >= F.lit(least)) & (F.col(o) <= F.lit(most)))
    if len(on) == 1 and 0 < size.n <= PUSHED_KEYS:
        values = [r[0] for r in k.distinct().collect() if r[0] is not None]  # at most PUSHED_KEYS
        df = df.filter(F.col(on[0]).isin(values))
    return df


def _block_and_masks(cols: Sequence[str], blocks: int) -> tuple[Column, list[Column]]:
    """Block number of a key, and its one bit in each of the block's words."""
    key = [F.col(f"`{c}`") for c in cols]
    bits = F.xxhash64(*key, F.lit(1))
    masks = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * j).bitwiseAND(F.lit(63)).cast("int"))
             for j in range(BLOCK_WORDS)]
    return F.pmod(F.xxhash64(*key), F.lit(blocks)), masks


def bloom_blocks(keys: DataFrame, cols: Sequence[str], n: int) -> tuple[DataFrame, int]:
    """A split-block Bloom filter of at most ``n`` keys: ``(__block, __w0 .. __w7)``, and its number of blocks.

    Built by one aggregation with map-side combining; about 1 in 100 absent keys passes.
    """
    blocks = max(1, -(-n * BLOOM_BITS // (64 * BLOCK_WORDS)))
    at, masks = _block_and_masks(cols, blocks)
    words = keys.select(at.alias("__block"), *[m.alias(f"__w{j}") for j, m in enumerate(masks)])
    return words.groupBy("__block").agg(*[F.bit_or(f"__w{j}").alias(f"__w{j}") for j in range(BLOCK_WORDS)]), blocks


def bloom_cut(df: DataFrame, keys: DataFrame, on: Sequence[str], key_cols: Sequence[str], n: int) -> DataFrame:
    """Rows of ``df`` that a Bloom filter of the ``n`` rows of ``keys`` lets pass: all that match, and few others.

    The types of ``on`` and ``key_cols`` must be the same, since their hashes are compared.
    """
    filter_rows, blocks = bloom_blocks(keys, key_cols, n)
    at, masks = _block_and_masks(on, blocks)
    cond = at == filter_rows["__block"]
    for j, m in enumerate(masks):
        cond &= filter_rows[f"__w{j}"].bitwiseAND(m) == m
    return df.join(F.broadcast(filter_rows), cond, "left_semi")  # at most BLOOM_MAX_BLOCKS rows


NULL_KEY_SPREAD = 512


def left_join_null_safe(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                        right_keys: Sequence[str], spread: int = NULL_KEY_SPREAD,
                        spread_by: str | None = None) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on equal keys, with NULL-key rows spread
    over many partitions.

    A left row with a NULL key can never match, but a shuffle join hashes
    every NULL key to the same partition: when many rows lack the key
    (charges without a receivable line, lines without a header) one task
    receives all of them. ``__null_salt`` takes the place of the first key:
    the key itself, or on rows that lack one a text that depends on a hash of the
    row, in ``[0, spread)``. The join also asks for the key to be there, so
    such a text meets nothing even if a key equals it. The right side is joined on
    its own columns, so a right side bucketed on them is not shuffled, and no
    input is read twice. ``spread_by`` names a column of many values whose hash is
    taken; without it the whole row is hashed. (Rows that hash alike stay together.)
    """
    salt = "__null_salt"
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in left_keys])
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in ([spread_by] if spread_by else left.columns)])
    first, other = left_keys[0], right_keys[0]
    own, theirs = F.col(first).cast("string"), right[other]
    if dict(right.dtypes)[other] != "string":  # equal values of one type have one text
        theirs = theirs.cast("string")
    text = F.concat(F.lit("\u0000"), F.pmod(row_hash, F.lit(spread)).cast("string"))
    l = left.withColumn(salt, F.when(no_key, text).otherwise(own))
    cond = (l[salt] == theirs) & l[first].isNotNull()
    for lk, rk in zip(left_keys[1:], right_keys[1:], strict=True):
        cond &= l[lk] == right[rk]
    return l.join(right, cond, "left").drop(l[salt])
