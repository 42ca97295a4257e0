"""Registered queries of the operators, and their DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dbtelemetry.llm import (bpe, decontamination, exact_dedup, langid, line_dedup, lm, minhash_dedup, mixing, nearest, runs,
                             sharding, toxicity, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        nearest.op1_multiprobe_lsh,
        bpe.op2_bpe,
        langid.op3_language_id,
        line_dedup.op4_line_dedup,
        minhash_dedup.op5_minhash_dedup,
        exact_dedup.op6_exact_dedup,
        lm.op7_lm_scores,
        sharding.op8_extendible_sharding,
        toxicity.op9_toxicity,
        mixing.op10_curriculum_mixing,
        decontamination.op11_suffix_decontamination,
        runs.op12_periodic_runs,
        whitening.op13_embedding_whitening,
    )
}

ORACLES: dict[str, str] = {
    "op4_line_dedup": line_dedup.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op8_extendible_sharding": sharding.ORACLE,
    "op10_curriculum_mixing": mixing.ORACLE,
    "op11_suffix_decontamination": decontamination.ORACLE,
}
