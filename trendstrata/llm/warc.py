"""Fixity audit of WARC replicas by Merkle trees over ordered offset ranges.

A record's address is its file's number and its offset in the file.  A tree
has one leaf per record (address, digest of the record's bytes), above it
ranges of 2**16 bytes of a file, of 2**24 bytes, whole files, and groups of 256
files and so on up to one root.  A node's digest covers its children's places
and digests in order, so a moved, missing or additional record changes it.

The audit compares the roots of two replicas and goes down only below nodes
that differ, so of two equal replicas it reads two rows.  Built-in functions
only; record bodies are hashed where they are read and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstrata.llm.common import stored, table

# Address bits that each level leaves out: ranges, wide ranges, files, groups of files.
SHIFTS = (16, 24, 31, 39, 47, 55, 63)
FILE_BITS = 31
RECORDS = 512  # of a file, about
FILE_BYTES = 1 << 28  # of a file, about, where that is fewer records
CRLF = "\r\n"


def warc_record(url: Column, body: Column, day: str = "2024-01-01") -> Column:
    """The record's text: WARC/1.1 headers, a blank line, the body, two line ends.  NULL counts as empty."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: resource{CRLF}WARC-Target-URI: "),
        url,
        F.lit(f"{CRLF}WARC-Date: {day}T00:00:00Z{CRLF}Content-Type: text/html{CRLF}Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(CRLF * 2),
        body,
        F.lit(CRLF * 2),
    )


def digest(record: Column) -> Column:
    return F.sha2(record.cast("binary"), 256)


def addressed(records: DataFrame, files: int) -> DataFrame:
    """``file, offset, address`` for records with ``page_id, length, digest, _place`` (12 hex digits).

    Files are ranges of places; a record begins where the one before it in its
    file ends; one that begins past the ``2**FILE_BITS`` bytes that addresses have for a file is an error.  Sorted by place, id and digest, so equal rows may change places freely.
    """
    from pyspark.sql import Window

    place = F.conv(F.substring("_place", 1, 8), 16, 10).cast("long")
    inside = Window.partitionBy("file").orderBy("_place", "page_id", "digest")
    before = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    placed = records.withColumn("file", F.floor(place * files / F.lit(2.0**32)))
    placed = placed.withColumn("offset", F.coalesce(before, F.lit(0)))
    too_far = F.raise_error(F.lit(f"a file of more than 2**{FILE_BITS} bytes: ask for more files")).cast("long")
    placed = placed.withColumn("offset", F.when(F.col("offset") + 1 < 1 << FILE_BITS, F.col("offset")).otherwise(too_far))
    return placed.withColumn("address", F.shiftleft(F.col("file").cast("long"), FILE_BITS) + F.col("offset"))


def files_for(records: int, size: int) -> int:
    """So many files that none has much more than ``RECORDS`` records or ``FILE_BYTES`` bytes."""
    return max(1, -(-records // RECORDS), -(-size // FILE_BYTES))


def level(nodes: DataFrame, shift: int) -> DataFrame:
    """Parents of ``node, digest`` rows per ``side``; a node has few hundred children at most."""
    children = F.sort_array(F.collect_list(F.struct("node", "digest")))
    joined = F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["node"].cast("string"), c["digest"])), ",")
    parent = F.shiftright("node", shift) if shift < 63 else F.lit(0).cast("long")
    return (
        nodes.groupBy("side", parent.alias("parent"))
        .agg(F.sha2(F.concat(F.lit("node,"), joined), 256).alias("digest"))
        .select("side", F.col("parent").alias("node"), "digest")
    )


def tree(leaves: DataFrame) -> list[DataFrame]:
    """All levels, leaves first, for the sides of ``side, address, digest`` rows."""
    at = leaves.groupBy("side", F.col("address").alias("node")).agg(F.sort_array(F.collect_list("digest")).alias("_all"))
    levels = [at.select("side", "node", F.array_join("_all", "+").alias("digest"))]
    below = 0
    for shift in SHIFTS:
        levels.append(stored(level(levels[-1], shift - below), "merkle"))
        below = shift
    return levels


def differing(nodes: DataFrame) -> DataFrame:
    """Nodes whose digests the sides ``a`` and ``b`` do not share."""
    sides = nodes.groupBy("node").agg(
        F.max(F.when(F.col("side") == "a", F.col("digest"))).alias("digest_a"),
        F.max(F.when(F.col("side") == "b", F.col("digest"))).alias("digest_b"),
    )
    return sides.filter(~F.col("digest_a").eqNullSafe(F.col("digest_b")))


def audit(replica_a: DataFrame, replica_b: DataFrame) -> DataFrame:
    """Addresses at which two replicas differ: ``address, kind, digest_a, digest_b``.

    Takes ``address, digest`` of each.  ``kind`` is altered, missing (from b)
    or extra (in b).  Several records at one address form one leaf, with their
    digests joined in order.  Two empty replicas do not differ.
    """
    one = replica_a.select(F.lit("a").alias("side"), "address", "digest")
    other = replica_b.select(F.lit("b").alias("side"), "address", "digest")
    levels = tree(one.unionByName(other))
    wrong = differing(levels[-1]).select("node")
    for depth in range(len(SHIFTS) - 1, -1, -1):
        shift = SHIFTS[depth] - (SHIFTS[depth - 1] if depth else 0)
        parent = F.shiftright("node", shift) if shift < 63 else F.lit(0).cast("long")
        below = levels[depth].withColumn("_parent", parent)
        if depth == len(SHIFTS) - 1:
            below = below.withColumn("_parent", F.lit(0).cast("long"))
        reached = below.join(wrong.withColumnRenamed("node", "_parent"), "_parent", "left_semi").drop("_parent")
        found = differing(reached)
        wrong = found.select("node")
    kind = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("altered")
    return found.select(F.col("node").alias("address"), kind.alias("kind"), "digest_a", "digest_b")


def op2_warc(spark, sf_dir: str) -> DataFrame:
    """All pages as one archive against a replica with damage at known pages, by a digest of their id:

    ``00`` the body's first character changed, ``01`` record lost, ``02`` a second
    copy one byte further on.
    """
    pages = table(spark, sf_dir, "pages")
    size = F.octet_length(F.coalesce("html", F.lit("")))
    files = files_for(*pages.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first())
    mark = F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), 1, 2)
    body = F.coalesce("html", F.lit(""))
    hurt = F.when(mark == "00", F.concat(F.lit("#"), F.substring(body, 2, 2**31 - 1))).otherwise(body)
    record = warc_record(F.col("url"), F.col("html"))
    records = pages.select(
        "page_id",
        mark.alias("_mark"),
        F.md5(F.concat_ws("|", F.col("page_id").cast("string"), "url")).alias("_place"),
        F.octet_length(record).cast("long").alias("length"),
        digest(record).alias("digest"),
        digest(warc_record(F.col("url"), hurt)).alias("_digest_b"),
    )
    placed = stored(addressed(records, files), "records")
    original = placed.select("address", "digest")
    kept = placed.filter("_mark <> '01'").select("address", F.col("_digest_b").alias("digest"))
    extra = placed.filter("_mark = '02'").select(F.col("address") + 1, F.col("_digest_b"))
    found = audit(original, kept.unionAll(extra))
    file = F.shiftright("address", FILE_BITS)
    return found.select(
        file.alias("file"), (F.col("address") - F.shiftleft(file, FILE_BITS)).alias("file_offset"),
        "kind", "digest_a", "digest_b",
    )


ORACLE = r"""
WITH crlf AS (SELECT chr(13) || chr(10) AS n),
bodies AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
    md5(concat_ws('|', CAST(page_id AS VARCHAR), url)) AS place, substr(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 2) AS mark
  FROM pages),
written AS (
  SELECT bodies.*, 'WARC/1.1' || n || 'WARC-Type: resource' || n || 'WARC-Target-URI: ' || url || n || 'WARC-Date: 2024-01-01T00:00:00Z' || n
    || 'Content-Type: text/html' || n || 'Content-Length: ' || strlen(html) || n || n || html || n || n AS record,
    CASE WHEN mark = '00' THEN '#' || substr(html, 2) ELSE html END AS hurt
  FROM bodies, crlf),
hashed AS (
  SELECT page_id, place, mark, strlen(record) AS length, sha256(record) AS digest,
    sha256('WARC/1.1' || n || 'WARC-Type: resource' || n || 'WARC-Target-URI: ' || url || n || 'WARC-Date: 2024-01-01T00:00:00Z' || n
    || 'Content-Type: text/html' || n || 'Content-Length: ' || strlen(hurt) || n || n || hurt || n || n) AS digest_b,
    CAST(floor(CAST('0x' || substr(place, 1, 8) AS BIGINT) * (SELECT greatest(ceil(count(*) / 512.0), ceil(sum(strlen(coalesce(html, ''))) / 268435456.0)) FROM pages) / 4294967296.0) AS BIGINT) AS file
  FROM written, crlf),
placed AS (
  SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY place, page_id, digest
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM hashed)
SELECT file, start AS file_offset, CASE WHEN mark = '01' THEN 'missing' ELSE 'altered' END AS kind, digest AS digest_a,
  CASE WHEN mark <> '01' THEN digest_b END AS digest_b
FROM placed WHERE mark = '01' OR digest <> digest_b
UNION ALL
SELECT file, start + 1, 'extra', NULL, digest_b FROM placed WHERE mark = '02'
"""
