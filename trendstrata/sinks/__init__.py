"""Writers: partitioned tables, landed raw documents, ledger and alerts."""

from trendstrata.sinks.landing import land_raw
from trendstrata.sinks.ledger import append_alerts, append_ledger, ledger_per_file, ledger_row
from trendstrata.sinks.tables import write_table

__all__ = [
    "append_alerts",
    "append_ledger",
    "land_raw",
    "ledger_per_file",
    "ledger_row",
    "write_table",
]
