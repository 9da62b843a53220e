"""Connected components and group-wise linking without all pairs."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Members of a group that one task compares with each other.
BLOCK = 4096
#: Weight (for sets: elements) of a block.
BLOCK_WEIGHT = 4_000_000
#: Members of a large group, drawn by hash, that all of its blocks share.
HUBS = 48
#: Members outside the main component that are compared with a block at a time.
REST = 256


#: A node with more than this share of all edge ends has its minimum broadcast.
HEAVY = 0.001


def _with_least(e: DataFrame, ends: int, label: str) -> DataFrame:
    """``(u, v, m)``: every edge end with the least neighbour ``m`` of ``u``; ``ends`` is their number at most.

    A node with many ends (fewer than ``1 / HEAVY`` nodes) has its minimum combined map-side and
    broadcast, so a star of any size is worked on where its edges lie. The other nodes' ends, none of which
    are many, meet in a window.
    """
    least = e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    heavy = F.broadcast(stage(least.filter(F.col("n") > F.lit(ends * HEAVY)).select("u", "m"), label))
    light = e.join(heavy.select("u"), "u", "left_anti").withColumn("m", F.min("v").over(Window.partitionBy("u")))
    return e.join(heavy, "u").select("u", "v", "m").unionByName(light.select("u", "v", "m"))


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every node of ``edges(a, b)``: the smallest id reachable.

    Alternating large-star and small-star contraction; each round is written,
    and the rounds grow with the logarithm of the longest path. No large star is brought to one task.
    """
    e = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        mark = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == before or mark["n"] == 0:
            break
        before = mark
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours go to the least of a node and its neighbours
        large = _with_least(both, 2 * mark["n"], "hubs").filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = stage(large, "large")
        # small star: a node and its smaller neighbours go to the least of these
        low = _with_least(large, mark["n"], "hubs")
        small = low.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct()
        e = stage(small, "stars")
    return (e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.left = n

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[a] = b
        self.left -= 1
        return True


#: fn(ids, payloads, component labels or None, side or None) -> pairs of positions that link, spanning enough
Linker = Callable[[np.ndarray, list, np.ndarray | None, np.ndarray | None], list[tuple[int, int]]]

EDGES = "a long, b long"


def _run(rows: DataFrame, keys: list[str], link_many, extra: list[str]) -> DataFrame:
    """Stream groups that were brought together by ``keys`` through ``link_many``."""
    def run(batches):
        held: list[pa.Table] = []

        def flush(table: pa.Table):
            pairs = link_many(table)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            # rows up to the start of the last group are complete
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            same = np.ones(batch.num_rows, bool)
            for c in cols:
                same &= c == c[-1]
            cut = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut == 0 and held and all(held[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in keys):
                held.append(table)
                continue
            if held and cut == 0:  # the whole batch is one new group
                yield from flush(pa.concat_tables(held))
                held = [table]
                continue
            if cut:
                yield from flush(pa.concat_tables([*held, table.slice(0, cut)]))
            held = [table.slice(cut)]
        if held:
            yield from flush(pa.concat_tables(held))
    brought = rows.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    return brought.select(*keys, "id", "n", "payload", *extra).mapInArrow(run, EDGES)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for k in keys:
        c = table.column(k).to_numpy()
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), table.num_rows)


def link_groups(members: DataFrame, link_blocks, label: str) -> DataFrame:
    """Edges whose components are those of all links inside the groups.

    ``members(grp long, id long, n long, payload binary)``. Groups of up to
    BLOCK members (and BLOCK_WEIGHT in sum of ``n``) are compared in one task, which
    returns a spanning forest of the links, not all of them. A larger group is
    cut into blocks that share a few hubs, so that blocks of one component
    meet through a hub; then only members outside the group's main component
    are compared with all blocks, across components. Every pair of different
    components inside a group is compared, so no link is lost, while copies of
    one text never become all pairs.

    ``link_blocks(ids, payloads, starts, comps, side)`` compares within each
    block (``side`` None) or rows of side 1 against all others across ``comps``.
    """
    members = stage(members, f"{label}-members")
    sizes = members.groupBy("grp").agg(F.count("*").alias("size"), F.sum("n").alias("weight")).filter("size > 1")
    sizes = sizes.withColumn("blocks", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / BLOCK_WEIGHT)).cast("int"))
    large = stage(sizes.filter("blocks > 1").select("grp", "size", "blocks"), f"{label}-large")
    h = F.xxhash64("id", F.lit(17))
    sized = members.join(large.hint("shuffle_hash"), "grp", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    hub = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("id", F.lit(5)), F.coalesce("size", F.lit(1))) < HUBS)
    placed = sized.withColumn("blk", F.explode(F.when(hub, F.sequence(F.lit(0), F.col("blocks") - 1))
                                               .otherwise(F.array(F.pmod(h, F.col("blocks")).cast("int")))))

    def within(table):
        return _call(table, ["grp", "blk"], link_blocks)
    edges = stage(_run(placed, ["grp", "blk"], within, []).distinct(), f"{label}-edges")
    if large.isEmpty():
        return edges
    comps = components(edges)
    big = members.join(large, "grp").join(comps, "id", "left").withColumn("comp", F.coalesce("component", "id"))
    big = stage(big.select("grp", "id", "n", "payload", "blocks", "comp"), f"{label}-big")
    main = (big.groupBy("grp", "comp").agg(F.count("*").alias("k")).groupBy("grp")
            .agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.sum("k").alias("size"), F.max("k").alias("top"))
            .filter("size > top").withColumn("chunks", F.ceil((F.col("size") - F.col("top")) / REST).cast("int")))
    big = big.join(main.select("grp", "main", "chunks"), "grp")
    rest = (big.filter("comp <> main").withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(29)), F.col("chunks")).cast("int"))
            .withColumn("blk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(1)))
    others = (big.withColumn("blk", F.pmod(h, F.col("blocks")).cast("int"))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("side", F.lit(0)))
    cols = ["grp", "blk", "chunk", "id", "n", "payload", "comp", "side"]

    def across(table):
        return _call(table, ["grp", "blk", "chunk"], link_blocks, True)
    more = _run(rest.select(cols).unionByName(others.select(cols)), ["grp", "blk", "chunk"], across, ["comp", "side"])
    return edges.unionByName(stage(more.distinct(), f"{label}-more"))


def _call(table: pa.Table, keys: list[str], link_blocks, across: bool = False) -> np.ndarray:
    table = table.combine_chunks()
    ids = table.column("id").to_numpy()
    comps = table.column("comp").to_numpy() if across else None
    side = table.column("side").to_numpy() if across else None
    pairs = link_blocks(ids, table.column("n").to_numpy(), table.column("payload").to_pylist(), _bounds(table, keys), comps, side)
    return np.array(sorted(pairs), np.int64).reshape(-1, 2)
