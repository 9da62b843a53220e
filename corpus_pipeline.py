"""Corpus pipeline: language ID, exact dedup, near dedup, suffix dedup, packing.

Every stage takes all that its predecessor kept; all but the last return the
columns of ``documents``. ``run`` writes each stage's result as Parquet under
the shared checkpoint folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargofeed.llm import exact_dedup, langid, near_dedup, packing, suffix_dedup
from cargofeed.llm.common import per_row, prepare, stage, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; those without text or without a letter go."""
    prepare(spark)
    return langid.keep_identified(docs)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    prepare(spark)
    return near_dedup.drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its text less repeated passages; ``n_chars`` follows the text."""
    prepare(spark)
    return per_row(docs, _cut)


def _cut(docs: DataFrame) -> DataFrame:
    kept = suffix_dedup.without_repeats(docs).withColumnsRenamed({"doc_id": "__id", "text": "__text"})
    rest = docs.drop("text").hint("shuffle_hash")
    out = kept.join(rest, rest["doc_id"].eqNullSafe(F.col("__id")))
    changed = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return out.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; the stages before leave the executors' heaps full, so workers save memory."""
    prepare(spark)
    return packing.pack_documents(docs, lean=True)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

#: Language models, suffix order and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
