"""Data-quality checks: one aggregate per table, one record per check."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendstrata.config import Settings
from trendstrata.errors import SPARK_ERRORS, reason
from trendstrata.functions import text_to_instant, zoneless_to_instant
from trendstrata.functions.text import quoted
from trendstrata.schemas import QUALITY_RECORD
from trendstrata.sources.tables import dq_input

Result = TypeVar("Result")

# The columns that say how fresh a table is, best first.
STAMP_COLUMNS = ("_processed_at", "_ingestion_timestamp")
WARNING_COLUMNS = ("video_id", "title", "channel_title", "views")


class QualityGateError(RuntimeError):
    """The checks did not pass, so the guarded stage was not run."""


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _record(check: str, table: str, passed: str, message: str, **values: str) -> str:
    """One record as a SQL expression; the arguments but ``check`` are SQL too.

    Text, since a record has a dozen fields and each Column call is a round
    trip to the JVM.
    """
    values |= {"check": _text(check), "table": table, "passed": passed, "message": message}
    return "named_struct({})".format(
        ", ".join(
            f"'{f.name}', CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()})"
            for f in QUALITY_RECORD.fields
        )
    )


@dataclass(frozen=True)
class Check:
    """What a check measures in the scan, and the records it makes of that."""

    record: str
    measures: Mapping[str, str | Column] = field(default_factory=dict)


def check_row_count(table: str, settings: Settings) -> Check:
    least = settings.min_rows
    message = f"concat(_rows, ' rows, at least {least} wanted')"
    record = _record("row_count", _text(table), f"_rows >= {least}", message, value="_rows", threshold=str(least))
    return Check(record, {"_rows": "count(1)"})


def check_null_pct(df: DataFrame, table: str, column: str, settings: Settings) -> Check:
    """Share of NULL (and NaN) in a critical column; an absent column fails."""
    name = _text(column)
    if column not in df.columns:
        return Check(_record("null_pct", _text(table), "false", f"concat('no column ', {name})", column=name))
    most = f"CAST({settings.max_null_pct} AS double)"
    measured, given = quoted(f"_null_{column}"), quoted(column)
    share = f"if(_rows > 0, {measured} / _rows * 100, 0D)"
    message = f"format_string('%s is %.2f %% NULL, at most %s %% allowed', {name}, bround({share}, 2), {most})"
    record = _record(
        "null_pct", _text(table), f"{share} <= {most}", message,
        column=name, value=f"bround({share}, 2)", threshold=most,
    )
    floating = isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))
    missing = f"{given} IS NULL" + (f" OR isnan({given})" if floating else "")
    return Check(record, {f"_null_{column}": f"count_if({missing})"})


def check_schema(df: DataFrame, table: str, settings: Settings) -> Check:
    """All critical columns are there."""
    missing = sorted(set(settings.critical_columns.get(table, ())) - set(df.columns))
    message = f"missing: {', '.join(missing)}" if missing else "all critical columns are there"
    names = f"array({', '.join(map(_text, missing))})"
    passed = "false" if missing else "true"
    return Check(_record("schema", _text(table), passed, _text(message), missing_columns=names))


def check_value_range(table: str, settings: Settings) -> Check:
    """No views below zero or above the limit."""
    most = settings.max_views
    record = _record(
        "value_range", _text(table), "_negative = 0 AND _extreme = 0",
        f"concat(_negative, ' negative and ', _extreme, ' above {most} views')",
        column="'views'", negative_count="_negative", extreme_count="_extreme",
    )
    return Check(record, {"_negative": "count_if(views < 0)", "_extreme": f"count_if(views > {most})"})


def check_freshness(df: DataFrame, table: str, settings: Settings, now: Column) -> Check:
    """Newest stamp within the limit.

    Fails open where there is nothing to read a time from: no stamp column, or
    a text that is not a time.  A table with only NULL stamps fails.
    """
    stamps = [c for c in STAMP_COLUMNS if c in df.columns]
    if not stamps:
        return Check(_record("freshness", _text(table), "true", "'no time stamp column, not checked'"))
    stamp = F.col(stamps[0])
    kind = df.schema[stamps[0]].dataType
    if isinstance(kind, T.StringType):
        instant = text_to_instant(stamp)
    else:
        instant = stamp if isinstance(kind, T.TimestampType) else zoneless_to_instant(stamp)
    record = _record(
        "freshness", _text(table), "_unparsed > 0 OR coalesce(_latest >= _cutoff, false)",
        "if(_unparsed > 0, 'time stamps cannot be read, not checked', concat_ws(' ', 'newest', _latest, 'limit', _cutoff))",
        latest_record="if(_unparsed > 0, NULL, _latest)", cutoff="if(_unparsed > 0, NULL, _cutoff)",
    )
    measures = {
        "_latest": F.max(instant),
        "_unparsed": F.count_if(stamp.isNotNull() & instant.isNull()),
        "_cutoff": now - F.make_dt_interval(hours=F.lit(settings.freshness_hours)),
    }
    return Check(record, measures)


def check_table(
    df: DataFrame, table: str, settings: Settings | None = None, now: Column | None = None
) -> DataFrame:
    """All records of one table from a single aggregate over it."""
    settings = settings or Settings()
    now = F.current_timestamp() if now is None else now
    checks = [
        check_row_count(table, settings),
        *[check_null_pct(df, table, c, settings) for c in settings.critical_columns.get(table, ())],
        check_schema(df, table, settings),
    ]
    if table in settings.range_checked and "views" in df.columns:
        checks.append(check_value_range(table, settings))
    checks.append(check_freshness(df, table, settings, now))
    measures = {name: measure for check in checks for name, measure in check.measures.items()}
    columns = [(F.expr(m) if isinstance(m, str) else m).alias(name) for name, m in measures.items()]
    records = ", ".join(check.record for check in checks)
    return df.agg(*columns).selectExpr(f"inline(array({records}))")


def check_tables(
    tables: Mapping[str, DataFrame], settings: Settings | None = None, now: Column | None = None
) -> DataFrame:
    """The records of several tables, lazily."""
    records = [check_table(df, name, settings, now) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), records)


def unreadable(spark: SparkSession, table: str, why: str) -> DataFrame:
    return failures(spark.range(1), "read_table", F.lit(table), F.lit(why))


def run_checks(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    settings: Settings | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Check each table now; one that cannot be read gives a failed record.

    ``tables`` maps names to functions that open the table.  What comes to the
    driver is a handful of records per table.
    """
    results = []
    for name, open_table in tables.items():
        try:
            records = check_table(dq_input(open_table()), name, settings, now).collect()
        except SPARK_ERRORS as error:
            records = unreadable(spark, name, reason(error)).collect()
        results.extend(records)
    return spark.createDataFrame(results, QUALITY_RECORD)


def summarise(results: DataFrame) -> DataFrame:
    """One row: did everything pass, and how many did.  No records pass."""
    return results.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("quality_passed"),
        F.count_if("passed").alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
    )


def gate(results: DataFrame, build: Callable[[], Result]) -> Result:
    """Run ``build`` only when every check passed."""
    verdict = summarise(results).first()
    if not verdict["quality_passed"]:
        failed = verdict["checks_total"] - verdict["checks_passed"]
        raise QualityGateError(f"{failed} of {verdict['checks_total']} checks failed")
    return build()


def failures(df: DataFrame, check: str, subject: Column, why: Column) -> DataFrame:
    """Failed records from rows that name a subject and a reason, such as bad files."""
    named = df.select(subject.alias("_subject"), why.alias("_why"))
    return named.selectExpr(f"inline(array({_record(check, '_subject', 'false', '_why')}))")


def alerts(results: DataFrame) -> DataFrame:
    """The records somebody should look at."""
    return results.filter(~F.col("passed"))


def warning_measures(condition: Column | None = None) -> list[Column]:
    """NULL counts and negative views of finished silver rows, as aggregates."""
    among = F.lit(True) if condition is None else condition
    nulls = [F.count_if(among & F.isnull(c)).alias(f"null_{c}") for c in WARNING_COLUMNS]
    return [*nulls, F.count_if(among & (F.col("views") < 0)).alias("negative_views")]


def silver_warnings(stats: DataFrame) -> DataFrame:
    """Counts worth a warning; they never stop anything."""
    return stats.agg(*warning_measures())
