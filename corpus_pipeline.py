"""A corpus pipeline over ``documents``: each stage reads what the one before kept.

Language identification drops what it rejects; of near-duplicate documents one
stays; passages that repeat are cut out; sources are mixed to their weights, which
repeats or leaves out documents; what is left is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendstrata.llm import jaccard, language, mixing, pieces, suffixes
from trendstrata.llm.common import stored, table

SHORT = int(1 / language.NARROW)  # bytes below which one byte is more than a narrow margin


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: those without a letter, and those no language explains better than the next.

    A text of fewer than ``SHORT`` bytes with a letter stays: its margin is narrow only in a tie or by one byte, which says nothing.
    """
    found = language.predict(docs, language.trained(docs))
    short = (F.octet_length(F.lower("text")) < SHORT) & (F.col("lang_pred") != language.UNKNOWN)
    return found.filter(~F.col("rejected") | F.coalesce(short, F.lit(False))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one with the smallest id."""
    return jaccard.one_of_each(docs, jaccard.near_duplicates(docs))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that occur twice are cut out; documents stay, also those left empty."""
    cut = suffixes.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document appears as often as the mix takes its words, rounded, so at most twice; one without words stays once.

    Documents whose source is above its target, and that the mix leaves out, go.
    """
    taken = mixing.taken_per_document(mixing.mix(docs))
    times = F.when(F.col("size") == 0, 1).otherwise(F.round(F.col("taken") / F.col("size")).cast("int"))
    # Rows that repeat an id, source and size share their takes evenly, the first ones getting the rest.
    keys = ["doc_id", "source", "size"]
    share = taken.withColumn("_times", times).groupBy(*keys).agg(F.sum("_times").alias("_times"), F.count(F.lit(1)).alias("_rows"))
    names = _unused(docs.columns, "id", "source", "size", "times", "rows", "words", "copies")
    share = share.select(*[F.col(k).alias(names[k.removeprefix("doc_")]) for k in keys], *[F.col(f"_{k}").alias(names[k]) for k in ("times", "rows")])
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(mixing.WORD)).cast("long")
    same = F.col("doc_id").eqNullSafe(F.col(names["id"])) & F.col("source").eqNullSafe(F.col(names["source"]))
    same &= F.col(names["words"]) == F.col(names["size"])
    measured = docs.withColumn(names["words"], words)
    once = measured.join(share.filter(F.col(names["rows"]) == 1), same).withColumn(names["copies"], F.col(names["times"]).cast("long"))
    # Equal rows are one with a number, so that a row that many repeat does not meet itself in one task.
    shared = measured.join(share.filter(F.col(names["rows"]) > 1), same)
    shared = shared.groupBy(*shared.columns).agg(F.count(F.lit(1)).alias(names["copies"]))
    before = Window.partitionBy(*[names[k.removeprefix("doc_")] for k in keys]).orderBy(*docs.columns).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(names["copies"]).over(before), F.lit(0))
    rest = F.greatest(F.least(F.col(names["times"]) % F.col(names["rows"]) - earlier, F.col(names["copies"])), F.lit(0))
    each = F.floor(F.col(names["times"]) / F.col(names["rows"])) * F.col(names["copies"]) + rest
    every = once.unionByName(shared.withColumn(names["copies"], each.cast("long")))
    repeated = F.explode(F.array_repeat(F.lit(0), F.col(names["copies"]).cast("int")))
    return every.withColumn(names["copies"], repeated).select(*docs.columns)


def _unused(columns: list[str], *wanted: str) -> dict[str, str]:
    """A name for each of ``wanted`` that no column has."""
    taken, names = {c.lower() for c in columns}, {}
    for name in wanted:
        own = f"_{name}"
        while own in taken:
            own = f"_{own}"
        names[name] = own
    return names


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256``."""
    import public_tokenizers

    # Nothing is remembered between tasks: the workers serve the other stages too.
    return pieces.encoded_and_checked(docs, public_tokenizers.path("piece_bpe_32k.model"), cache=200_000, keep=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("sentencepiece", tokenised),
]

# Compression, min-hash sampling and Viterbi are beyond SQL; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
