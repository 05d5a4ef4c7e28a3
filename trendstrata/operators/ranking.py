"""Row numbers inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITTERS = 64  # of each group


def _precedes(a: Column, b: Column, order: Sequence[tuple[str, bool]]) -> Column:
    """Whether ``a`` stands before ``b``: NULL first where ascending, last where not."""
    before, same = F.lit(False), F.lit(True)
    for name, ascending in order:
        x, y = a[name], b[name]
        if ascending:
            less = (x < y) | (x.isNull() & y.isNotNull())
        else:
            less = (x > y) | (x.isNotNull() & y.isNull())
        before = before | (same & F.coalesce(less, F.lit(False)))
        same = same & x.eqNullSafe(y)
    return before


def _same(groups: Sequence[str], prefix: str) -> Column:
    return reduce(and_, [F.col(g).eqNullSafe(F.col(f"{prefix}{i}")) for i, g in enumerate(groups)], F.lit(True))


def _named(groups: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(g).alias(f"{prefix}{i}") for i, g in enumerate(groups)]


def rank_within(
    df: DataFrame, groups: Sequence[str], order: Sequence[tuple[str, bool]], name: str, rows: DataFrame | None = None
) -> DataFrame:
    """``row_number`` by ``order`` inside ``groups``, without a task per group.

    ``order`` names columns and whether they ascend; it should be total inside a group.

    A window would sort a whole group in one task.  Here some rows of each group, chosen by a hash of
    their values, cut it into buckets, and a row's bucket is the number of those before it.  The rank is the
    place inside the bucket plus the rows of the buckets before.  Bucket and rank depend on the values
    alone, so nothing needs to be kept between the passes, and nothing runs before the result is asked for.

    ``rows`` may give the columns of ``groups`` and ``order`` of the same rows by a shorter way; choosing and counting read those.
    """
    rows = df if rows is None else rows
    names = [n for n, _ in order]
    place = F.xxhash64(*names)
    drawn = (
        rows.groupBy(*groups, F.pmod(place, F.lit(SPLITTERS)).alias("_salt"))
        .agg(F.min(F.struct(place.alias("_hash"), *names)).alias("_splitter"))
        .groupBy(*groups)
        .agg(F.collect_list("_splitter").alias("_splitters"))
        .select(*_named(groups, "_g"), "_splitters")
    )

    def bucketed(which: DataFrame) -> DataFrame:
        here = F.struct(*names)
        before = F.size(F.filter("_splitters", lambda s: _precedes(s, here, order)))
        joined = which.join(drawn, _same(groups, "_g"))
        return joined.withColumn("_bucket", before).drop("_splitters", *[f"_g{i}" for i, _ in enumerate(groups)])

    # At most one row per splitter and one more in a group.
    earlier = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed(rows.select(*groups, *[n for n in names if n not in groups]))
        .groupBy(*groups, "_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_base", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .select(*_named(groups, "_o"), F.col("_bucket").alias("_b"), "_base")
    )
    sort = [F.asc_nulls_first(n) if ascending else F.desc_nulls_last(n) for n, ascending in order]
    inside = F.row_number().over(Window.partitionBy(*groups, "_bucket").orderBy(*sort))
    numbered = bucketed(df).withColumn("_place", inside)
    ranked = numbered.join(offsets, _same(groups, "_o") & (F.col("_bucket") == F.col("_b")))
    return ranked.select(*df.columns, (F.col("_place") + F.col("_base")).cast("long").alias(name))
