"""Sharding: contiguous shards of nearly equal bytes, by global prefix sums.

All rows have one order: by a digest of the text, then by one of the id.  So equal
texts lie side by side.  The order is cut into partitions by value; their totals
are summed up first, then each row adds what lies before it inside its partition.
A shard is what lies between two multiples of an equal part of all bytes.

A group of equal texts stays in one shard while it is at most one ``WHOLE``-th of a
shard; a larger one is cut at the same multiples, between rows.  A text whose rows
would fill more than one partition is dealt to several by the digest of the id.

Everything is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendstrata.llm.common import shuffle_parts, stored, table

SHARDS = 24
WHOLE = 64  # a group of up to one in so many parts of a shard stays together
OVERHEAD = 8  # bytes that a row counts beside its text

UNIT = ["_key", "_salt"]


def _leading(digest: str) -> Column:
    """The first 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32`` and the digests that give the order; a NULL text has no bytes."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text).alias("_key"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_at"),
    )


def _salted(rows: DataFrame, many: int, parts: int) -> DataFrame:
    """``_salt``: 0, or for a text with more than ``many`` rows its part by the id's digest.

    At most ``parts`` texts have more than one in ``parts`` of all rows, so the table of them is small.
    """
    heavy = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > many)
    heavy = heavy.select("_key", F.least(F.ceil(F.col("_rows") / F.lit(many)), F.lit(parts)).cast("long").alias("_salts"))
    salt = F.shiftright(_leading("_at") * F.coalesce("_salts", F.lit(1)), 32)
    return rows.join(F.broadcast(heavy), "_key", "left").withColumn("_salt", salt).drop("_salts")


def _units(counted: DataFrame, parts: int) -> DataFrame:
    """One row per text and salt, in the global order, with what lies before it and before its text."""
    units = counted.groupBy(*UNIT).agg(F.sum("_copies").alias("_n"), F.max("size").alias("_size"))
    units = units.withColumn("_part", F.shiftright(_leading("_key") * F.lit(parts), 32))
    order = Window.partitionBy("_part").orderBy(*UNIT).rowsBetween(Window.unboundedPreceding, -1)
    text = Window.partitionBy("_part", "_key")
    inside = units.withColumns(
        {
            "_rows_in": F.coalesce(F.sum("_n").over(order), F.lit(0)),
            "_bytes_in": F.coalesce(F.sum(F.col("_n") * F.col("_size")).over(order), F.lit(0)),
        }
    ).withColumns(
        {
            "_group_rows": F.sum("_n").over(text),
            "_group_first": F.min("_rows_in").over(text),
            "_group_start": F.min("_bytes_in").over(text),
        }
    )
    # One row per partition: as many as the session has shuffle partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = units.groupBy("_part").agg(F.sum("_n").alias("_rows"), F.sum(F.col("_n") * F.col("_size")).alias("_bytes"))
    totals = totals.select(
        "_part",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
    )
    placed = inside.join(F.broadcast(totals), "_part")
    return placed.select(
        *UNIT,
        "_n",
        "_size",
        "_group_rows",
        (F.col("_rows_before") + F.col("_rows_in")).alias("_first"),
        (F.col("_rows_before") + F.col("_group_first")).alias("_group_first"),
        (F.col("_bytes_before") + F.col("_group_start")).alias("_group_start"),
    )


def _quotient(a: Column, b: Column) -> Column:
    """Whole quotient of longs that are not negative."""
    return F.call_function("div", a, b)


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, whole: int = WHOLE) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row.

    Shards are contiguous in the order of the texts' digests and differ by
    no more than one ``whole``-th of a shard and one text.  ``slot`` counts the rows
    of a shard from 0 without gaps.  NULL texts count as empty ones and a NULL
    id comes first in its group; repeated rows take slots of their own, any of
    them the same.  Other columns are ignored; an empty table gives no rows.
    Needs all sizes together below 2**63 / (2 * shards) bytes.
    """
    parts = shuffle_parts(docs.sparkSession)
    rows = stored(measured(docs), "sizes")
    totals = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    total = F.lit(max(1, totals["bytes"])).cast("long")
    salted = _salted(rows, max(1, -(-totals["rows"] // parts)), parts)
    counted = salted.groupBy(*UNIT, "_at", "doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_copies"))
    units = stored(_units(counted, parts), "units")

    def shard(start: Column, size: Column) -> Column:
        """The shard that holds the middle of these bytes."""
        return _quotient((2 * start + size) * shards, 2 * total)

    group_bytes = F.col("_group_rows") * F.col("_size")
    together = group_bytes * shards <= _quotient(total, F.lit(whole))
    middle = shard(F.col("_group_start"), group_bytes)

    def of_row(index: Column) -> Column:
        start = F.col("_group_start") + (index - F.col("_group_first")) * F.col("_size")
        return F.when(together, middle).otherwise(shard(start, F.col("_size")))

    # The first row of each shard: of the units that reach into it, the least; inside
    # a cut group it is the first row whose middle is not before the shard's start.
    reached = units.withColumn("_shard", F.explode(F.sequence(of_row(F.col("_first")), of_row(F.col("_first") + F.col("_n") - 1))))
    short = 2 * total * F.col("_shard") - shards * (2 * F.col("_group_start") + F.col("_size"))
    step = 2 * shards * F.col("_size")
    entered = F.col("_group_first") + _quotient(F.greatest(short, F.lit(0)) + step - 1, step)
    first = F.when(together, F.col("_first")).otherwise(F.greatest(F.col("_first"), entered))
    starts = reached.groupBy("_shard").agg(F.min(first).alias("_shard_first"))  # one row per shard

    inside = Window.partitionBy(*UNIT).orderBy("_at", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counted.withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).drop("size")
    places = F.sequence(F.col("_first") + F.col("_before"), F.col("_first") + F.col("_before") + F.col("_copies") - 1)
    placed = (
        numbered.join(units, UNIT)
        .withColumn("_index", F.explode(places))
        .withColumn("_shard", of_row(F.col("_index")))
        .join(F.broadcast(starts), "_shard")
    )
    return placed.select(
        "doc_id",
        F.col("_size").alias("size"),
        "text_crc32",
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_index") - F.col("_shard_first")).alias("slot"),
    )


def op12_sharding(spark, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(table(spark, sf_dir, "documents"))
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


# The checksum is folded over the bytes with the table of its polynomial.
ORACLE = r"""
WITH RECURSIVE crc_table(k, i, c) AS (
  SELECT 0, range, range::UBIGINT FROM range(256)
  UNION ALL
  SELECT k + 1, i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM crc_table WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS steps FROM crc_table WHERE k = 8),
sized AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size,
    md5(coalesce(text, '')) AS key, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS spot
  FROM documents),
checked AS (
  SELECT doc_id, size, key, spot,
    CAST(xor(list_reduce(
      list_prepend(4294967295::UBIGINT,
        list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda p: CAST('0x' || p AS UBIGINT))),
      lambda c, b: xor(c >> 8, steps[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295::UBIGINT) AS BIGINT) AS text_crc32
  FROM sized, crc),
placed AS (
  SELECT *, row_number() OVER w AS place, CAST(sum(size) OVER w AS HUGEINT) - size AS start,
    CAST(sum(size) OVER (PARTITION BY key) AS HUGEINT) AS group_bytes, CAST(sum(size) OVER () AS HUGEINT) AS total
  FROM checked WINDOW w AS (ORDER BY key, spot, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
grouped AS (SELECT *, min(start) OVER (PARTITION BY key) AS group_start FROM placed),
sharded AS (
  SELECT *, CAST(CASE WHEN group_bytes * 24 <= total // 64
    THEN ((2 * group_start + group_bytes) * 24) // (2 * total)
    ELSE ((2 * start + size) * 24) // (2 * total) END AS INTEGER) AS shard
  FROM grouped)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM sharded
"""
