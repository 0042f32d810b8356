"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import (conversation, forced_bpe, langid, learned_ann, license_scan, maxscore,
                           packing, quality, simhash, substring_dedup, token_files, toxicity,
                           whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.query,
    "op2_quality": quality.query,
    "op3_maxscore": maxscore.query,
    "op4_best_fit_packing": packing.query,
    "op5_learned_ann": learned_ann.query,
    "op6_bpe_forced_split": forced_bpe.query,
    "op7_language_id": langid.query,
    "op8_license_scan": license_scan.query,
    "op9_token_files": token_files.query,
    "op10_simhash_dedup": simhash.query,
    "op11_whitening": whitening.query,
    "op12_substring_dedup": substring_dedup.query,
    "op13_conversation_repair": conversation.query,
}

ORACLE: dict[str, str] = {"op3_maxscore": maxscore.ORACLE_SQL,
                          "op12_substring_dedup": substring_dedup.ORACLE_SQL}
