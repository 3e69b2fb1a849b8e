"""Registered queries of the training-data operators, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import (
    ball_search,
    best_two_fit,
    class_lm,
    conversation_repair,
    fm_dedup,
    gray_simhash,
    lexicon_codec,
    line_dedup,
    mih_search,
    piece_codec,
    posting_lists,
    toxicity,
    zstd_quality,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": line_dedup.query,
    "op2_posting_lists": posting_lists.query,
    "op3_piece_codec": piece_codec.query,
    "op4_class_lm": class_lm.query,
    "op5_toxicity": toxicity.query,
    "op6_gray_simhash": gray_simhash.query,
    "op7_zstd_quality": zstd_quality.query,
    "op8_fm_dedup": fm_dedup.query,
    "op9_best_two_fit": best_two_fit.query,
    "op10_mih_search": mih_search.query,
    "op11_lexicon_codec": lexicon_codec.query,
    "op12_ball_search": ball_search.query,
    "op13_conversation_repair": conversation_repair.query,
}

SQL: dict[str, str] = {
    "op1_line_dedup": line_dedup.SQL,
    "op10_mih_search": mih_search.SQL,
    "op12_ball_search": ball_search.SQL,
}
