"""Queries of the text operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensoria.llm import (
    chat,
    collocations,
    divergence,
    hamming,
    language,
    line_dedup,
    maxent,
    merkle,
    minhash,
    packing,
    quality,
    sentencepiece,
    toxicity,
)
from sensoria.session import configure

ORACLE: dict[str, str] = {
    "op3_hamming": hamming.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_divergence": divergence.ORACLE,
    "op13_chat": chat.ORACLE,
}


def _ready(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(configure(spark), folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _ready(query)
    for query in (
        quality.op1_quality,
        line_dedup.op2_line_dedup,
        hamming.op3_hamming,
        language.op4_language,
        minhash.op5_minhash,
        packing.op6_packing,
        sentencepiece.op7_sentencepiece,
        maxent.op8_maxent,
        merkle.op9_fingerprints,
        toxicity.op10_toxicity,
        collocations.op11_collocations,
        divergence.op12_divergence,
        chat.op13_chat,
    )
}
