"""The stages in order: silver, checks, and gold behind the gate."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trendstrata.config import Settings
from trendstrata.errors import SPARK_ERRORS, reason
from trendstrata.operators.audit import expected_regions, landing_audit
from trendstrata.operators.categories import category_lookup, empty_documents
from trendstrata.operators.quality import QualityGateError, alerts, failures, gate, run_checks
from trendstrata.plans.gold import GOLD_TABLES, changed_days, gold_from_partials, gold_tables, merged_partials
from trendstrata.plans.reference import reference_rows, silver_reference
from trendstrata.plans.silver import GOOD, REJECT_COLUMNS, REJECTS, routed, settle, stage_measures, tallied_statistics
from trendstrata.schemas import CORRUPT
from trendstrata.session import fresh_folder, kept
from trendstrata.sinks.ledger import append_alerts, append_ledger, ledger_per_file, ledger_row
from trendstrata.sinks.tables import write_routed, write_table
from trendstrata.sources.category_json import read_category_json
from trendstrata.sources.manifest import changes, listed_files
from trendstrata.sources.split_csv import read_split_statistics
from trendstrata.sources.statistics_csv import read_raw_statistics
from trendstrata.sources.tables import read_table, table_exists


@dataclass(frozen=True)
class Places:
    """Folders of one deployment; all must be reachable from every executor."""

    raw_statistics: str
    raw_reference: str
    silver: str
    gold: str
    ledger: str
    alerts: str


@dataclass
class Run:
    """One run over one deployment."""

    spark: SparkSession
    places: Places
    settings: Settings = field(default_factory=Settings)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def _silver(self, table: str) -> str:
        return f"{self.settings.silver_db}.{table}"

    def _note(self, stage: str, **values) -> None:
        append_ledger(ledger_row(self.spark, self.run_id, stage, **values), self.places.ledger)

    def _alert(self, failed: DataFrame) -> None:
        if not failed.isEmpty():
            append_alerts(failed, self.places.alerts, self.run_id)

    def _alert_one(self, check: str, subject: str, why: str) -> None:
        self._alert(failures(self.spark.range(1), check, F.lit(subject), F.lit(why)))

    def prepare(self) -> None:
        for database in (self.settings.silver_db, self.settings.gold_db):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def landing(self, landed: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
        """Which expected regions landed both kinds of documents; the others raise alerts."""
        expected = expected_regions(self.spark, regions or self.settings.regions)
        audit = landing_audit(landed, expected)
        missing = F.concat(F.lit("did not land: "), "failed_kind")
        self._alert(failures(audit.filter("status = 'failed'"), "landing", F.col("region"), missing))
        return audit

    @contextmanager
    def _watched(self, stage: str, source: str, path: str) -> Iterator[None]:
        """A failure is noted and alerted before it goes on."""
        try:
            yield
        except Exception as error:
            self._note(stage, source=source, path=path, error=reason(error))
            self._alert_one(stage, source, reason(error))
            raise

    def statistics(
        self, encoding: str = "ISO-8859-1", drop_corrupt: bool = True, multi_line: bool = True, split: bool = False
    ) -> dict[str, int]:
        """Raw files to the silver statistics table in one pass over the files.

        The same pass sets corrupt rows apart, with their text, into the table of rejects;
        ``drop_corrupt=False`` keeps them as padded or cut rows.  A rerun gives the
        same tables, since all of both is replaced: regions that left the feed go.
        A failure leaves both as they were.  An empty feed writes nothing.
        ``split`` reads large files with line breaks inside quotes in many tasks.
        """
        name, path = self.settings.statistics_table, f"{self.places.silver}/statistics"
        with self._watched("silver_statistics", name, path):
            listed = self._listed()
            raw = self._raw(self.places.raw_statistics, encoding, multi_line, split)
            if raw.isEmpty():
                self._note("silver_statistics", rows_written=0)
                return {"rows": 0}
            counts = self._write_statistics(tallied_statistics(raw, self.settings.job_name, drop_corrupt=drop_corrupt), drop_corrupt, "replace")
            self._remember(listed, "replace")
            return counts

    def statistics_increment(
        self, encoding: str = "ISO-8859-1", multi_line: bool = True, split: bool = False
    ) -> dict[str, int]:
        """What has landed since the last run, merged into the silver table.

        Files that the manifest does not name are read; their regions' stored rows are merged with them
        by key, and only those partitions are written.  The greatest row of a key
        is the same whether it is sought at once or bit by bit, so the table is the one
        that ``statistics`` would make, but for the stamps of rows that were there.
        Where a file has changed or gone, its region is read anew; where a
        region has no files left, or there is no manifest yet, everything is.
        The manifest is written last: a run that fails is repeated by the next, with the same result.
        """
        name, path = self.settings.statistics_table, f"{self.places.silver}/statistics"
        known = [self.settings.statistics_table, self.settings.rejects_table, self.settings.manifest_table]
        if not all(table_exists(self.spark, t, self.settings.silver_db) for t in known):
            return self.statistics(encoding, multi_line=multi_line, split=split)
        with self._watched("silver_increment", name, path):
            listed = self._listed()
            change = changes(listed, read_table(self.spark, self.settings.manifest_table, self.settings.silver_db))
            if change.vanished:
                return self.statistics(encoding, multi_line=multi_line, split=split)
            if not change.files:
                self._note("silver_increment", rows_written=0)
                return {"rows": 0, "files": 0}
            raw = self._raw(change.files, encoding, multi_line, split)
            merged = F.col("region").isin(sorted(set(change.regions) - set(change.anew)))
            stored = read_table(self.spark, name, self.settings.silver_db).filter(merged)
            files = listed.filter(F.col("path").isin(change.files)).select("_source_file")
            rejects = read_table(self.spark, self.settings.rejects_table, self.settings.silver_db).filter(merged)
            tallied = tallied_statistics(
                raw, self.settings.job_name, drop_corrupt=True, stored=stored,
                stored_rejects=rejects.join(files, "_source_file", "left_anti"),
            )
            counts = self._write_statistics(tallied, True, "overwrite_partitions")
            self._remember(listed.filter(F.col("region").isin(change.regions)), "overwrite_partitions")
            counts.pop("rows_removed")  # stored rows have no raw ones to be counted against
            return counts | {"files": len(change.files)}

    def _raw(self, path: str | Sequence[str], encoding: str, multi_line: bool, split: bool) -> DataFrame:
        if split:
            return read_split_statistics(self.spark, path, encoding)
        return read_raw_statistics(self.spark, path, encoding, multi_line)

    def _listed(self) -> DataFrame:
        """The files as they are before they are read; kept, so that a file that lands meanwhile counts as new later."""
        listed = listed_files(self.spark, self.places.raw_statistics)
        folder = fresh_folder(self.spark, "listing")
        listed.write.parquet(folder)
        return self.spark.read.schema(listed.schema).parquet(folder)

    def _remember(self, listed: DataFrame, mode: str) -> None:
        name, path = self._silver(self.settings.manifest_table), f"{self.places.silver}/files"
        write_table(listed, name, path, mode=mode)

    def _write_statistics(self, tallied: DataFrame, drop_corrupt: bool, mode: str) -> dict[str, int]:
        name, path = self.settings.statistics_table, f"{self.places.silver}/statistics"
        accounted = Observation()
        tallied = tallied.observe(accounted, *stage_measures())
        # The deduplication leaves large tasks that hold every region, so each
        # writes few, large files; balancing would shuffle the widest table
        # once more.
        if drop_corrupt:
            rows = routed(tallied)
            good = [c for c in rows.columns if c not in ("kind", "rows", "_source_file", CORRUPT)]
            tables = {GOOD: (self._silver(name), good), REJECTS: (self._silver(self.settings.rejects_table), REJECT_COLUMNS)}
            written = write_routed(rows, tables, path, mode=mode)
            counts = {"rows": written[GOOD], "rejects": written[REJECTS]}
        else:
            counts = write_table(settle(tallied), self._silver(name), path, mode=mode, balance=False)
        counts |= accounted.get
        self._note("silver_statistics", source=name, rows_written=counts["rows"], path=path)
        return counts

    def reference(self, at: Column | None = None, multi_line: bool = True) -> dict[str, int]:
        """Category documents to the silver reference table; bad files are noted and passed over.

        The texts are parsed once; the passes after that read the parsed documents.
        """
        name, path = self.settings.reference_table, f"{self.places.silver}/reference_data"
        with self._watched("silver_reference", name, path):
            docs = read_category_json(
                self.spark, self.places.raw_reference, multi_line, keep=lambda parsed: self._kept(parsed, "documents")
            )
            if docs.isEmpty():
                self._note("silver_reference", rows_written=0)
                return {"rows": 0}
            counts = write_table(silver_reference(docs, at=at), self._silver(name), path)
            rejects = empty_documents(docs)
            entries = ledger_per_file(reference_rows(docs), rejects, self.run_id, "silver_reference", path)
            append_ledger(entries, self.places.ledger)
            self._alert(failures(rejects, "read_file", F.col("_source_file"), F.col("error")))
            return counts

    def checks(self, now: Column | None = None) -> DataFrame:
        """Check records of both silver tables; failed ones are kept as alerts."""
        openers = {
            table: lambda table=table: read_table(self.spark, table, self.settings.silver_db)
            for table in (self.settings.statistics_table, self.settings.reference_table)
        }
        results = run_checks(self.spark, openers, self.settings, now)
        self._alert(alerts(results))
        return results

    def _reference(self) -> DataFrame | None:
        """The reference table if there is one that can be read."""
        name = self.settings.reference_table
        if not table_exists(self.spark, name, self.settings.silver_db):
            return None
        try:
            reference = read_table(self.spark, name, self.settings.silver_db)
            lookup = category_lookup(reference)
            self._note("category_lookup", source=name, rows_written=lookup.count() if lookup else 0)
            return reference
        except SPARK_ERRORS as error:
            self._note("category_lookup", source=name, error=reason(error))
            return None

    def gold(self) -> dict[str, int]:
        """The three summaries with their row counts; empty statistics write nothing.

        The tables are replaced one after the other.  A failure leaves the
        earlier ones updated and the others as they were; a rerun brings all in line.
        """
        stats = read_table(self.spark, self.settings.statistics_table, self.settings.silver_db)
        if stats.isEmpty():
            self._note("gold", rows_written=0)
            return {}
        return self._write_gold(gold_tables(stats, self._reference()), "replace")

    def _write_gold(self, tables: Mapping[str, Callable[[], DataFrame]], mode: str) -> dict[str, int]:
        written = {}
        for table, build in tables.items():
            path = f"{self.places.gold}/{table}"
            try:
                counts = write_table(build(), f"{self.settings.gold_db}.{table}", path, mode=mode)
            except Exception as error:
                self._note("gold", source=table, path=path, error=reason(error))
                self._alert_one("gold", table, reason(error))
                raise
            written[table] = counts["rows"]
            self._note("gold", source=table, rows_written=counts["rows"], path=path)
        return written

    def gold_increment(self) -> dict[str, int]:
        """The three summaries, for the regions whose statistics have changed since the last call.

        Sums per region, day, channel and category are kept in a table of partials with the latest
        stamp of the rows they stand for.  Days whose stamp differs are summed up anew from the
        statistics; a changed region's summaries come from its partials, and the number of
        a channel's videos from its ``channel_title`` and ``video_id``.  The first call, and
        one after a region has gone, makes everything.
        """
        stats = read_table(self.spark, self.settings.statistics_table, self.settings.silver_db)
        name, path = self.settings.partials_table, f"{self.places.silver}/partials"
        gold_tables_known = all(table_exists(self.spark, t, self.settings.gold_db) for t in GOLD_TABLES)
        fresh = not (gold_tables_known and table_exists(self.spark, name, self.settings.silver_db))
        held = None if fresh else read_table(self.spark, name, self.settings.silver_db)
        days = self._kept(changed_days(stats, held), "days")
        regions = {r["region"]: r["gone"] for r in days.groupBy("region").agg(F.bool_and(F.col("state") == "gone").alias("gone")).collect()}
        if not regions:
            self._note("gold_increment", rows_written=0)
            return {}
        # A region that has gone as a whole has no rows to replace its partitions with.
        if any(regions.values()):
            held, fresh = None, True
            days = self._kept(changed_days(stats, None), "days")
            regions = {r["region"]: False for r in days.select("region").distinct().collect()}
        mode = "replace" if fresh else "overwrite_partitions"
        own = stats if fresh else stats.filter(F.col("region").isin(sorted(regions)))
        partials = self._kept(merged_partials(own, held, days), "partials")
        reference = self._reference()
        written = self._write_gold(gold_from_partials(partials, own, reference), mode)
        # Last: a failed call is repeated by the next.
        write_table(partials, self._silver(name), path, mode=mode)
        return written

    def _kept(self, df: DataFrame, label: str) -> DataFrame:
        return kept(df, label)

    def everything(self, now: Column | None = None, incremental: bool = False, **reading) -> dict[str, int]:
        """Silver, checks, gate, gold.  Raises when the checks do not pass.

        ``incremental`` takes only what has landed since; ``reading`` goes to the statistics' reader.
        """
        self.prepare()
        self.reference()
        if incremental:
            self.statistics_increment(**reading)
        else:
            self.statistics(**reading)
        try:
            return gate(self.checks(now), self.gold_increment if incremental else self.gold)
        except QualityGateError as error:
            self._note("gate", error=str(error))
            raise
