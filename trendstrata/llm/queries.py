"""One query per operator over the given tables, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trendstrata.llm import chat, fim, jaccard, language, mixing, mtree, neighbours, phrases, pieces, sharding, suffixes, tokens, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": chat.op1_chat,
    "op2_warc": warc.op2_warc,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_token_files": tokens.op4_token_files,
    "op5_language": language.op5_language,
    "op6_jaccard": jaccard.op6_jaccard,
    "op7_neighbours": neighbours.op7_neighbours,
    "op8_mixing": mixing.op8_mixing,
    "op9_suffixes": suffixes.op9_suffixes,
    "op10_mtree": mtree.op10_mtree,
    "op11_fim": fim.op11_fim,
    "op12_sharding": sharding.op12_sharding,
    "op13_phrases": phrases.op13_phrases,
}
ORACLES: dict[str, str] = {
    "op1_chat": chat.ORACLE,
    "op2_warc": warc.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op10_mtree": mtree.ORACLE,
    "op11_fim": fim.ORACLE,
    "op12_sharding": sharding.ORACLE,
    "op13_phrases": phrases.ORACLE,
}
