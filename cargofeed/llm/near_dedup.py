"""Operator 8, MinHash near-dedup with odd sketches.

A document's set is its distinct 5-word shingles. Equal sets are one class.
Each class has ``SAMPLES`` MinHash values, banded for candidate search, and
folded into an odd sketch: a parity bitmap whose XOR with another one counts
the samples in which two sets differ. The steps:

1. classes that share a band (``ROWS`` equal MinHash values) are compared by
   sketch, group by group (:mod:`graph`); the components of pairs that may
   reach the threshold are clusters,
2. the members' full sets, taken anew from their whole texts, are brought together once per
   cluster and links are confirmed on them, ``100 * intersection >= 75 * union``,
3. components of the confirmed links are the result.

Shingles are compared by 64-bit hashes of their words' 64-bit hashes, both mixed step by step: two of
n different shingles that are compared share one with a probability of about n^2 / 2^65.

A pair at the threshold shares no band with probability (1 - 0.75^5)^40, about
2e-5, and its sketch passes the estimate unless it errs by over four standard
deviations; clearly similar pairs are missed far less often. Bands of any size
are worked off in blocks; no bucket is capped and no pair list is built.

Defined cases: texts without words (NULL, empty, blank) have the empty set,
size 0, and are linked with nothing; texts of fewer than five words have one
shingle. Rows that share a ``doc_id`` share a component if their sets do.
A row without a ``doc_id`` takes no part: NULL component, kept. Extra columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, id_text, keep_rows, map_batches, per_row, stage
from .fingerprints import mix
from .graph import Forest, components, link_groups

WORDS = 5
SAMPLES = 200
ROWS = 5
BITS = 512
NUMERATOR, DENOMINATOR = 75, 100
#: Pairs whose sketches estimate less than this are not confirmed.
ESTIMATE = 0.55

_RNG = np.random.default_rng(8)
_A = _RNG.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_SALT = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_STEP = _RNG.integers(0, 1 << 62, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PIECE = 1 << 20

#: XOR population count of two sketches at the estimate ESTIMATE.
MAX_XOR = int(BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * SAMPLES * (1 - ESTIMATE))))


_TAIL = (np.uint64(1) << (np.arange(8, dtype=np.uint64) * np.uint64(8))) - np.uint64(1)


def hash_ranges(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty byte range: eight bytes a step, each step mixed with the state so far.

    Steps do not commute or add up, so no family of different words shares its hash by construction.
    """
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each position on
    size = (end - start).astype(np.int64)
    state = mix(size.astype(np.uint64) + _SALT[0])
    live, at = np.arange(len(start)), start.astype(np.int64)
    while len(live):
        left = size[live] - (at - start[live])
        part = eight[at]
        part = np.where(left >= 8, part, part & _TAIL[np.minimum(left, 7)])
        state[live] = mix((state[live] ^ part) * _STEP[0] + _SALT[1])
        more = left > 8
        live, at = live[more], at[more] + 8
    return state


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash per word, A-Z lower-cased; bounded memory however long the text."""
    buf = _LOWER[np.frombuffer(text, np.uint8)]
    parts, at = [], 0
    while at < len(buf):
        end = min(at + _PIECE, len(buf))
        while end < len(buf) and not _SPACE[buf[end]]:  # never cut a word
            gap = np.flatnonzero(_SPACE[buf[end:end + 4096]])
            end = end + int(gap[0]) if len(gap) else min(end + 4096, len(buf))
        part = buf[at:end]
        solid = np.concatenate([[False], ~_SPACE[part], [False]])
        edge = np.flatnonzero(solid[1:] != solid[:-1])
        if len(edge):
            parts.append(hash_ranges(part, edge[::2], edge[1::2]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    w = word_hashes(text.encode("utf-8"))
    if not len(w):
        return w
    if len(w) < WORDS:
        h = np.full(1, len(w), np.uint64)
        for k in range(len(w)):
            h = mix((h ^ w[k:k + 1]) * _STEP[k] + _SALT[k])
        return h
    n = len(w) - WORDS + 1
    h = mix(w[:n] * _STEP[0] + _SALT[0])
    for k in range(1, WORDS):
        h = mix((h ^ w[k:k + n]) * _STEP[k] + _SALT[k])
    return np.unique(h)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 4096):
        np.minimum(low, (x[None, at:at + 4096] * _A[:, None] + _B[:, None]).min(axis=1), out=low)
    return low


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of (sample number, MinHash value)."""
    bit = (mix(samples.astype(np.uint64) ^ _SALT) % np.uint64(BITS)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=BITS) & 1).astype(np.uint8))


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(-1, ROWS).astype(np.uint64)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
    for k in range(ROWS):
        key = mix(key ^ rows[:, k]) + _SALT[k]
    return key


SIGNATURES = "doc_id long, n long, digest binary, sketch binary, bands binary"


def signatures(docs: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, digest, sketch, bands = [], [], [], []
        for text in batch.column("text").to_pylist():
            s = shingle_set(text)
            n.append(len(s))
            if len(s):
                m = min_hashes(s)
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sketch.append(odd_sketch(m).tobytes())
                bands.append(band_keys(m).tobytes())
            else:
                digest.append(None)
                sketch.append(None)
                bands.append(None)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), *(pa.array(c, pa.binary()) for c in (digest, sketch, bands))],
            names=["doc_id", "n", "digest", "sketch", "bands"])
    return map_batches(id_text(docs), run, SIGNATURES)


def _band_rows(classes: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(np.repeat(batch.column("id").to_numpy(), SAMPLES // ROWS))], names=["grp", "id"])
    return map_batches(classes.select("id", "bands"), run, "grp long, id long")


def _xor_counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Population counts of the XOR of all rows of ``a`` with all of ``b`` (8-byte words)."""
    out = np.empty((len(a), len(b)), np.uint16)
    for at in range(0, len(a), 64):
        out[at:at + 64] = np.bitwise_count(a[at:at + 64, None, :] ^ b[None, :, :]).sum(axis=2, dtype=np.uint16)
    return out


def _may_link(na, nb):
    lo, hi = np.minimum(na, nb), np.maximum(na, nb)
    return lo * DENOMINATOR >= hi * NUMERATOR


def sketch_links(ids, n, payload, bounds, comps, side):
    """Links by sketch estimate and set sizes, a spanning forest per block."""
    words = np.frombuffer(b"".join(payload), np.uint64).reshape(len(ids), -1)
    size = np.diff(bounds)
    out = set()
    if side is None:
        for s in range(2, 13):  # small groups of one size together, all their pairs at once
            at = bounds[:-1][size == s]
            for i in range(s if len(at) else 0):
                for j in range(i + 1, s):
                    x, y = at + i, at + j
                    ok = ((np.bitwise_count(words[x] ^ words[y]).sum(axis=1, dtype=np.uint16) <= MAX_XOR)
                          & _may_link(n[x], n[y]) & (ids[x] != ids[y]))
                    a, b = ids[x[ok]], ids[y[ok]]
                    out.update(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if side is not None and b - a > 1:
            out.update(_across(ids[a:b], n[a:b], words[a:b], None, comps[a:b], side[a:b]))
        elif b - a > 12:
            out.update(_within(ids[a:b], n[a:b], words[a:b], None))
    return out


def _within(ids, n, words, sets):
    """Spanning forest of one block's links; sets None: the sketch decides, else the full sets do.

    From each member reached, only those not reached yet are compared.
    """
    rest, out = np.arange(len(ids)), []
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = (np.bitwise_count(words[rest] ^ words[x]).sum(axis=1, dtype=np.uint16) <= MAX_XOR) & _may_link(n[rest], n[x])
            if sets is not None:
                hit = np.flatnonzero(near)
                near[hit] = [_linked(sets[x], sets[y]) for y in rest[hit].tolist()]
            found = rest[near].tolist()
            rest = rest[~near]
            queue += found
            out += [(min(int(ids[x]), int(ids[y])), max(int(ids[x]), int(ids[y]))) for y in found if ids[x] != ids[y]]
    return out


def _across(ids, n, words, sets, comps, side):
    """Links of rows of side 1 with the others that join different components."""
    rows, cols = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
    _, node = np.unique(comps, return_inverse=True)
    forest, out = Forest(int(node.max()) + 1), []
    counts = _xor_counts(words[rows], words[cols])
    ok = (counts <= MAX_XOR) & _may_link(n[rows][:, None], n[cols][None, :]) & (node[rows][:, None] != node[cols][None, :])
    i, j = np.nonzero(ok)
    order = np.argsort(counts[i, j], kind="stable")  # the most similar first
    for x, y in zip(rows[i[order]].tolist(), cols[j[order]].tolist(), strict=True):
        p, q = node[x], node[y]
        if forest.find(p) != forest.find(q) and (sets is None or _linked(sets[x], sets[y])):
            forest.join(p, q)
            out.append((min(int(ids[x]), int(ids[y])), max(int(ids[x]), int(ids[y]))))
    return out


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


def exact_links(ids, n, payload, bounds, comps, side):
    """Confirmed links, a spanning forest per block. A payload is the sketch, then the full set."""
    words = np.frombuffer(b"".join([p[:BITS // 8] for p in payload]), np.uint64).reshape(len(ids), -1)
    sets = [np.frombuffer(p, np.uint64)[BITS // 64:] for p in payload]
    out = set()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if side is not None and b - a > 1:
            out.update(_across(ids[a:b], n[a:b], words[a:b], sets[a:b], comps[a:b], side[a:b]))
        elif b - a > 1:
            out.update(_within(ids[a:b], n[a:b], words[a:b], sets[a:b]))
    return out


SETS = "grp long, id long, n long, payload binary"


def _full_sets(docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Sets of the class representatives in ``clusters(id, component, digest)``, from their whole texts."""
    wanted = clusters.select(F.col("id").alias("doc_id"), "component", "digest")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted.hint("shuffle_hash")
    rows = id_text(docs).join(wanted, "doc_id").select("doc_id", "text", "component", "digest")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, n, payload = [], [], []
        for i, (text, digest) in enumerate(zip(batch.column("text").to_pylist(), batch.column("digest").to_pylist(), strict=True)):
            s = shingle_set(text)
            # another row may share the id; its set has a class of its own
            if len(s) and hashlib.blake2b(s.tobytes(), digest_size=16).digest() == digest:
                keep.append(i)
                n.append(len(s))
                payload.append(odd_sketch(min_hashes(s)).tobytes() + s.tobytes())
        keep = pa.array(keep, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("component").take(keep), batch.column("doc_id").take(keep), pa.array(n, pa.int64()),
             pa.array(payload, pa.binary())], names=["grp", "id", "n", "payload"])
    return map_batches(rows, run, SETS)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    sig = stage(signatures(docs), "signatures")
    with_set = sig.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stage(with_set.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").alias("id"), "n", "sketch", "bands")).alias("c"), F.count("*").alias("rows"))
        .select("digest", "rows", "c.*"), "classes")
    bands = _band_rows(classes)
    shared = bands.groupBy("grp").agg(F.count("*").alias("k")).filter("k > 1").select("grp")
    members = bands.join(shared.hint("shuffle_hash"), "grp", "left_semi")
    members = members.join(classes.select("id", "n", F.col("sketch").alias("payload")), "id")
    clusters = components(link_groups(members.select("grp", "id", "n", "payload"), sketch_links, "bands"))
    clusters = stage(clusters.join(classes.select("id", "digest"), "id"), "clusters")
    links = link_groups(_full_sets(docs, clusters), exact_links, "sets")
    linked = components(links)
    # only classes of several rows or with a link differ from their own row
    named = (classes.filter("rows > 1").select("digest", "id")
             .join(linked, "id", "full_outer").select("id", "digest", F.coalesce("component", "id").alias("component")))
    named = (named.filter("digest IS NOT NULL").unionByName(
        named.filter("digest IS NULL").drop("digest").join(classes.select("id", "digest"), "id").select("id", "digest", "component")))
    named = stage(named.select("digest", "component").distinct(), "named")
    named = F.broadcast(named) if named.count() <= BROADCAST_IDS // 2 else named
    out = sig.select("doc_id", "n", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component (the smallest id) stays, all columns.

    Rows without a ``doc_id`` stay; rows that share one are compared as documents of their own.
    """
    known = docs.filter("doc_id IS NOT NULL")
    out = per_row(known, _keep)
    nameless = docs.filter("doc_id IS NULL")
    return out if nameless.isEmpty() else out.unionByName(nameless)


def _keep(docs: DataFrame) -> DataFrame:
    kept = stage(near_duplicates(docs).groupBy("doc_id").agg(F.count("*").alias("n_rows"), F.bool_or("kept").alias("kept"))
                 .filter("kept"), "kept")
    return keep_rows(docs, kept)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) = 0 THEN []::VARCHAR[]
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS sh
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT x AS doc_id, x AS r FROM both_ways
  UNION
  SELECT b.x, reach.r FROM reach JOIN both_ways b ON b.y = reach.doc_id),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id,
       coalesce(c.component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
