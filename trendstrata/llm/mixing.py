"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents, in an order given by a digest of their id, form one
stream of tokens that repeats; the stream is cut into blocks of equally many
tokens.  Slot ``t`` of the mix goes to the source whose interval of cumulative
targets holds the golden-ratio point ``frac((t + 1/2) * 0.618...)``.  The slots
of a source are ranked, and rank ``r`` takes block ``r`` of its stream.

Everything is built-in expressions.  A source of any size is cut into buckets
of about ``BUCKET`` documents for the running sums, so a hot source spreads over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendstrata.llm.common import stored, table

# What counts as a word, and the query's weights.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)

GOLDEN = 0.6180339887498949
BLOCK = 1024  # tokens of a block
BUCKET = 1024  # documents of one running sum
CHUNK = 4096  # slots of one ranking
BINS = 4096  # of the guide that finds a point's source

KEY = ["_known", "_name"]  # a source, with NULL apart from the empty name


def measured(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, source, size`` and a row number ``_row``; a NULL text has size 0."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"), F.monotonically_increasing_id().alias("_row"))


def keyed(df: DataFrame) -> DataFrame:
    return df.withColumns({"_known": F.col("source").isNotNull(), "_name": F.coalesce("source", F.lit(""))})


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source with its ``target`` tokens.

    Weights repeat over the sources by code point, NULL last.  Targets share
    ``share`` times all tokens; none passes ``most`` times its source, and what
    is above goes to the others by weight.  With sources in the order in which
    they reach their cap, the level of a source is what is left per unit of
    weight once all before it are capped; the first source whose cap lies above
    its level fixes the level of all uncapped ones.

    The windows without partition see one row per source.
    """
    by_name = Window.orderBy(F.desc("_known"), "_name")
    sources = (
        keyed(sizes)
        .groupBy(*KEY)
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
        .withColumn("_index", F.row_number().over(by_name))
        .withColumn(
            "weight",
            F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("_index") - 1, F.lit(len(weights))) + 1),
        )
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    )
    everything = Window.partitionBy()
    capped_first = Window.orderBy(F.col("_cap") / F.col("weight"), "_index")
    before = capped_first.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = sources.withColumns(
        {"_place": F.row_number().over(capped_first), "_level": left / weight_left}
    ).withColumn("_free", F.col("_cap") / F.col("weight") > F.col("_level"))
    level = F.min(F.when(F.col("_free"), F.struct("_place", "_level"))).over(everything)
    by_weight = F.col("weight") * level.getField("_level")
    return levels.withColumn(
        "target", F.when(level.isNull() | (F.col("_cap") <= by_weight), F.col("_cap")).otherwise(by_weight)
    ).select(*KEY, "_index", "_docs", "source_size", "weight", "target")


def _whole(target: str = "target") -> Column:
    return F.floor(target)


def schedule(goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """``slot, _known, _name, rank``: which source each slot of the mix takes its next block from.

    A source has as many slots as its target has blocks.  Points beyond that
    are left out; a source that the points give too few slots (by the
    discrepancy, a few) gets the missing ones after the last point.
    """
    spark = goals.sparkSession
    goals = goals.withColumn("_quota", F.ceil(_whole() / F.lit(block)))
    upto = Window.orderBy("_index")
    share = F.sum("_quota").over(Window.partitionBy())
    cut = goals.filter("_quota > 0").select(
        *KEY,
        "_index",
        "_quota",
        (F.coalesce(F.sum("_quota").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) / share).alias("_lo"),
        (F.sum("_quota").over(upto.rowsBetween(Window.unboundedPreceding, 0)) / share).alias("_hi"),
    )
    slots = goals.agg(F.sum("_quota")).first()[0] or 0
    guide = cut.withColumn(
        "_bin", F.explode(F.sequence(F.floor(F.col("_lo") * BINS), F.least(F.floor(F.col("_hi") * BINS), F.lit(BINS - 1))))
    )
    point = F.pmod((F.col("slot") + 0.5) * F.lit(GOLDEN), F.lit(1.0))
    points = spark.range(slots).select(F.col("id").alias("slot")).withColumn("_at", point)
    points = points.withColumn("_bin", F.floor(F.col("_at") * BINS))
    placed = (
        points.join(guide, "_bin")
        .filter((F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi")))
        .withColumn("_chunk", F.floor(F.col("slot") / CHUNK))
        .select("slot", "_chunk", *KEY, "_quota")
    )
    chunks = placed.groupBy(*KEY, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*KEY).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    in_chunk = F.row_number().over(Window.partitionBy(*KEY, "_chunk").orderBy("slot"))
    ranked = (
        placed.withColumn("_in", in_chunk)
        .join(chunks, [*KEY, "_chunk"])
        .withColumn("rank", F.col("_base") + F.col("_in") - 1)
        .filter(F.col("rank") < F.col("_quota"))
        .select("slot", *KEY, "rank")
    )
    given = chunks.groupBy(*KEY).agg(F.sum("_n").alias("_given"))
    missing = (
        cut.join(given, KEY, "left")
        .withColumn("_given", F.coalesce("_given", F.lit(0)))
        .filter(F.col("_given") < F.col("_quota"))
        .withColumn("rank", F.explode(F.sequence("_given", F.col("_quota") - 1)))
        .withColumn("slot", F.lit(slots) - 1 + F.row_number().over(Window.orderBy("rank", "_index")))
        .select("slot", *KEY, "rank")
    )
    return ranked.unionByName(missing)


def pieces(sizes: DataFrame, goals: DataFrame, block: int = BLOCK, most: float = 2.0) -> DataFrame:
    """Where each document lies in its source's stream: a row per document and block it reaches into.

    ``rank`` is the block, ``tokens`` how many of the document's tokens lie in
    it, ``first`` the number of the first of these.  A document that the target
    does not reach has one row with a NULL rank.
    """
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    docs = (
        keyed(sizes)
        .join(goals, KEY)
        .withColumn("_digest", digest)
        .withColumn(
            "_bucket",
            F.floor(
                F.conv(F.substring("_digest", 1, 8), 16, 10).cast("long") * F.ceil(F.col("_docs") / BUCKET) / F.lit(2.0**32)
            ),
        )
    )
    inside = Window.partitionBy(*KEY, "_bucket").orderBy("_digest", "doc_id", "size", "_row")
    docs = docs.withColumn("_end", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    earlier = Window.partitionBy(*KEY).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        docs.groupBy(*KEY, "_bucket")
        .agg(F.sum("size").alias("_tokens"))
        .withColumn("_base", F.coalesce(F.sum("_tokens").over(earlier), F.lit(0)))
        .drop("_tokens")
    )
    docs = docs.join(buckets, [*KEY, "_bucket"]).withColumn("_start", F.col("_base") + F.col("_end") - F.col("size"))

    def reached(epoch: int) -> Column:
        lo = F.col("_start") + F.col("source_size") * epoch
        hi = F.least(lo + F.col("size"), _whole())
        ranks = F.sequence(F.floor(lo / block), F.floor((hi - 1) / block))
        there = F.transform(ranks, lambda r: F.struct(r.alias("rank"), lo.alias("lo"), hi.alias("hi")))
        return F.when(hi > lo, there).otherwise(F.array().cast("array<struct<rank:bigint,lo:bigint,hi:bigint>>"))

    at = F.explode_outer(F.concat(*[reached(epoch) for epoch in range(max(1, math.ceil(most)))])).alias("_at")
    keep = ["_row", "doc_id", "source", "size", "source_size", "target"]
    cut = docs.select(*keep, *KEY, at).withColumn("rank", F.col("_at.rank"))
    low = F.greatest(F.col("_at.lo"), F.col("rank") * block)
    high = F.least(F.col("_at.hi"), (F.col("rank") + 1) * block)
    return cut.select(*keep, *KEY, "rank", (low - F.col("_at.lo")).alias("first"), (high - low).alias("tokens"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix: one row per slot and document part, and one without slot per document left out.

    Columns ``slot, doc_id, source, first, tokens`` besides ``size``,
    ``source_size``, ``target`` and the row number ``_row`` of the document.
    Whole tokens of a target are taken exactly.  Repeated rows are documents of
    their own; ties of the order go by id, size and row.  An empty table gives no rows.
    """
    sizes = stored(measured(docs), "sizes")
    goals = stored(targets(sizes, weights, share, most), "targets")
    cut = pieces(sizes, goals, most=most)
    return cut.join(schedule(goals), [*KEY, "rank"], "left").drop(*KEY)


def taken_per_document(mixed: DataFrame) -> DataFrame:
    """``taken``: tokens of each document that the slots of the mix hold, and the first such slot."""
    return mixed.groupBy("_row", "doc_id", "source", "size", "source_size", "target").agg(
        F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("tokens"))), F.lit(0)).alias("taken"),
        F.min("slot").alias("first_slot"),
    )


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    taken = taken_per_document(mix(table(spark, sf_dir, "documents")))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER w, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level,
    row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS place
  FROM sources
  WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
leveled AS (SELECT *, min_by(level, place) FILTER (WHERE cap / weight > level) OVER () AS final FROM filled),
goals AS (
  SELECT source, source_size,
    CASE WHEN final IS NULL OR cap <= weight * final THEN cap ELSE weight * final END AS target
  FROM leveled),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, CAST(floor(g.target) AS BIGINT) AS whole,
    CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(CAST(s.doc_id AS VARCHAR), '')), s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - s.size AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  greatest(least(start + size, whole) - start, 0)
    + greatest(least(source_size + start + size, whole) - (source_size + start), 0) AS taken
FROM placed
"""
