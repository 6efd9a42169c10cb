"""The subpackage's queries, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm import alignment, bpe, chat, chunks, divergence, langid, lattice, mixing, quality, secrets, simhash, toxicity, winnow


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": chunks.op1_substring_dedup,
        "op2_bpe": bpe.op2_bpe,
        "op3_lattice": lattice.op3_lattice,
        "op4_langid": langid.op4_langid,
        "op5_winnowing": winnow.op5_winnowing,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_simhash": simhash.op7_simhash,
        "op8_secrets": secrets.op8_secrets,
        "op9_chat": chat.op9_chat,
        "op10_quality": quality.op10_quality,
        "op11_mixing": mixing.op11_mixing,
        "op12_divergence": divergence.op12_divergence,
        "op13_alignment": alignment.op13_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_lattice": lattice.ORACLE, "op5_winnowing": winnow.ORACLE, "op9_chat": chat.ORACLE, "op12_divergence": divergence.ORACLE}
