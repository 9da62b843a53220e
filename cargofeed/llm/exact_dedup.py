"""Operator 2, exact dedup: heavy-hitter split (DataFrame functions only).

Every text is read once, into a narrow table of SHA-256 digests of the
normalised text. A Misra-Gries summary (``freqItems``: one bounded counter map
per task, merged) names every digest that can hold more than ``SUPPORT`` of
the rows. Their exact winners are computed by a map-side combined aggregate,
verified against the threshold and broadcast (at most ``1 / SUPPORT`` rows),
so rows of hot groups are decided where they are and never shuffled. The
remaining digests, none of which is frequent, go through an ordinary shuffle:
groups are combined map-side and joined back to their rows, a sort-merge join
whose larger partitions the skew join splits, so that no group has to be one task.

Defined cases: NULL text counts as empty; all empty or blank texts are one
group. Ties go to the longest original text, then the smallest ``doc_id``
(NULL last), then one row of those that repeat a ``doc_id``; each group keeps
exactly one row in :func:`drop_duplicates`, whatever the ids, while the
decision table gives every row, repeated or not, its group's ``keep_id``.
An empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, keep_rows, per_row, stage, without_space

#: A digest above this share of all rows is decided by broadcast.
SUPPORT = 0.002


def digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_cp, digest)`` per row: code points of the original text and
    the SHA-256 of the normalised one."""
    t = id_text(docs)
    return t.select("doc_id", F.length("text").alias("n_cp"),
                    F.unhex(F.sha2(without_space(F.col("text")).cast("binary"), 256)).alias("digest"))


def _winner():
    # largest (n_cp, ~doc_id): ~x falls as x rises and cannot overflow; a NULL id loses
    return F.max(F.struct("n_cp", F.bitwise_not(F.col("doc_id")).alias("inv")))


def decide(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per document: its group's digest, size and the id that stays."""
    rows = stage(digests(docs), "digests")
    total = rows.count()
    frequent = rows.stat.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    heavy = (rows.join(F.broadcast(frequent), "digest", "left_semi")
             .groupBy("digest").agg(F.count("*").alias("group_size"), _winner().alias("best"))
             .filter(F.col("group_size") >= F.lit(support * total)))
    heavy = stage(heavy, "heavy")  # at most 1 / support rows
    hot = F.broadcast(heavy)
    decided = rows.join(hot, "digest").select("doc_id", "digest", "group_size", "best")
    cold = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    groups = cold.groupBy("digest").agg(F.count("*").alias("group_size"), _winner().alias("best"))
    rest = cold.join(groups.hint("merge"), "digest").select("doc_id", "digest", "group_size", "best")
    return decided.unionByName(rest).select(
        "doc_id", F.bitwise_not(F.col("best.inv")).alias("keep_id"), "group_size",
        F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The decision table: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    return decide(docs, support).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The documents that stay, all columns: one row of each group."""
    return per_row(docs, lambda rows: _keep(rows, support))


def _keep(docs: DataFrame, support: float) -> DataFrame:
    kept = stage(exact_dedup(docs, support).filter("kept").groupBy("doc_id").agg(F.count("*").alias("n_rows")), "kept")
    return keep_rows(docs, kept)


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT text_sha256, count(*) AS group_size, first(doc_id ORDER BY n_cp DESC, doc_id) AS keep_id
  FROM t GROUP BY text_sha256)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256
FROM t JOIN g USING (text_sha256)
"""
