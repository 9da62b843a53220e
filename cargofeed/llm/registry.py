"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import (ann, bpe, chat, exact_dedup, html_extract, langid, near_dedup, packing, secrets, suffix_dedup, token_count,
               vector_codes, whitening)
from .common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def _on(name: str, fn: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(table(spark, sf_dir, name))
    return run


def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(chat.format_conversations(turns.unionByName(chat.probe(spark))))


def queries() -> dict[str, Query]:
    return {
        "op1_language_id": _on("documents", langid.identify),
        "op2_exact_dedup": _on("documents", exact_dedup.exact_dedup),
        "op3_token_counts": _on("documents", token_count.token_counts),
        "op4_bpe": _on("documents", bpe.token_digests),
        "op5_nearest": _on("embeddings", ann.nearest),
        "op6_packing": _on("documents", packing.pack_documents),
        "op7_html_extract": _on("pages", html_extract.extract),
        "op8_near_dedup": _on("documents", near_dedup.near_duplicates),
        "op9_chat_format": _chat,
        "op10_suffix_dedup": _on("documents", suffix_dedup.repeated_spans),
        "op11_vector_codes": _on("embeddings", vector_codes.compress),
        "op12_secret_scan": _on("documents", secrets.scan),
        "op13_whitening": _on("embeddings", whitening.whiten),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": exact_dedup.ORACLE_SQL, "op8_near_dedup": near_dedup.ORACLE_SQL,
            "op9_chat_format": chat.ORACLE_SQL, "op10_suffix_dedup": suffix_dedup.ORACLE_SQL,
            "op11_vector_codes": vector_codes.ORACLE_SQL}
