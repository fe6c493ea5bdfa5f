"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docvec.llm import (
    chat,
    decontaminate,
    mixing,
    neighbors,
    passages,
    phrases,
    pii,
    quality,
    ranking,
    secrets,
    sharding,
    simhash,
    tokens,
)

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> dict[str, Query]:
    found = (
        chat.op1_chat,
        quality.op2_quality,
        decontaminate.op3_decontamination,
        mixing.op4_mixing,
        neighbors.op5_neighbors,
        sharding.op6_sharding,
        passages.op7_passages,
        secrets.op8_secrets,
        simhash.op9_simhash,
        tokens.op10_tokens,
        phrases.op11_phrases,
        ranking.op12_search,
        pii.op13_pii,
    )
    return {f.__name__: f for f in found}


def oracles() -> dict[str, str]:
    return {
        "op3_decontamination": decontaminate.OP3_SQL,
        "op4_mixing": mixing.OP4_SQL,
        "op8_secrets": secrets.OP8_SQL,
        "op11_phrases": phrases.OP11_SQL,
        "op12_search": ranking.OP12_SQL,
        "op13_pii": pii.OP13_SQL,
    }
