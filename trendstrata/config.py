"""Names, thresholds and limits used across the stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# The checks and gold tables are defined by these, and by the thresholds below.
REGIONS = ("us", "gb", "ca", "de", "fr", "in", "jp", "kr", "mx", "ru")
UNKNOWN_CATEGORY = "Unknown"
CRITICAL_COLUMNS: Mapping[str, Sequence[str]] = {
    "clean_statistics": ("video_id", "title", "channel_title", "views", "region"),
    "clean_reference_data": ("id", "region"),
}


@dataclass(frozen=True)
class Settings:
    """One run's configuration; the defaults are the production thresholds."""

    silver_db: str = "silver"
    gold_db: str = "gold"
    statistics_table: str = "clean_statistics"
    reference_table: str = "clean_reference_data"
    rejects_table: str = "rejected_statistics"
    manifest_table: str = "statistics_files"
    partials_table: str = "statistics_partials"
    job_name: str = "bronze_to_silver"
    regions: Sequence[str] = REGIONS

    # The thresholds of the checks.
    min_rows: int = 10
    max_null_pct: float = 5.0
    max_views: int = 50_000_000_000
    freshness_hours: int = 48
    critical_columns: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: dict(CRITICAL_COLUMNS)
    )
    # Tables whose `views` column must stay inside 0 .. max_views.
    range_checked: Sequence[str] = ("clean_statistics",)
