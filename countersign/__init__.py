"""Reconciliation of two copies of a table on Spark."""

from countersign.operators.compare import compare, differences, in_order, places_in_order
from countersign.operators.ordering import numbered
from countersign.operators.partitions import (
    partition_bounds, partition_keys, partition_range, stored_partition_keys,
)
from countersign.operators.profile import profile, row_counts
from countersign.operators.rollup import (
    failing_tables, partition_reasons, partition_status, run_totals, table_status,
)
from countersign.operators.schema import is_partitioned, numeric_columns
from countersign.operators.sqltext import check_sql
from countersign.plans.report import report_lines, write_report
from countersign.plans.run import RunResult, run
from countersign.sources.catalog import attach_metadata, prefetch_metadata, table_metadata
from countersign.sources.manifest import read_manifest
from countersign.sources.tables import Stored, TableSpec, open_for_counts

__all__ = [
    "RunResult", "Stored", "TableSpec", "attach_metadata", "check_sql", "compare",
    "differences", "failing_tables", "in_order", "is_partitioned", "numbered", "numeric_columns",
    "open_for_counts", "partition_bounds", "partition_keys", "partition_range", "partition_reasons",
    "partition_status", "places_in_order", "prefetch_metadata", "profile", "read_manifest", "report_lines",
    "row_counts", "run", "run_totals", "stored_partition_keys", "table_metadata", "table_status", "write_report",
]
