"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headway.llm import (
    alignment,
    archive,
    chat,
    ctw,
    decontaminate,
    embeddings,
    hard_negatives,
    line_dedup,
    near_join,
    packing,
    passages,
    token_counts,
    toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": token_counts.op1_token_counts,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op3_warc": archive.op3_warc,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_best_fit_packing": packing.op5_best_fit_packing,
        "op6_chat_formatting": chat.op6_chat_formatting,
        "op7_ngram_jaccard_join": near_join.op7_ngram_jaccard_join,
        "op8_embedding_near_dedup": embeddings.op8_embedding_near_dedup,
        "op9_lm_scoring": ctw.op9_lm_scoring,
        "op10_benchmark_decontamination": decontaminate.op10_benchmark_decontamination,
        "op11_substring_dedup": passages.op11_substring_dedup,
        "op12_cross_tokenizer_alignment": alignment.op12_cross_tokenizer_alignment,
        "op13_hard_negative_mining": hard_negatives.op13_hard_negative_mining,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": line_dedup.SQL,
        "op3_warc": archive.SQL,
        "op6_chat_formatting": chat.SQL,
        "op8_embedding_near_dedup": embeddings.SQL,
        "op10_benchmark_decontamination": decontaminate.SQL,
        "op11_substring_dedup": passages.SQL,
        "op13_hard_negative_mining": hard_negatives.SQL,
    }
