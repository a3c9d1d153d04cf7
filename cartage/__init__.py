"""Cartage: table migration as a handful of set-based Spark jobs.

A run profiles a source table by one or more partition keys, exports the
selected partitions as Parquet, inspects the staged files by their footers,
loads them into a target dataset and reconciles the row counts. Progress lives
in append-only logs that are themselves DataFrames.
"""

from cartage.operators.export import analyse_partitions, export_pending, export_table, retry_failed
from cartage.operators.load import import_files
from cartage.operators.target import Target, read_target

__all__ = [
    "Target",
    "analyse_partitions",
    "export_pending",
    "export_table",
    "import_files",
    "read_target",
    "retry_failed",
]
