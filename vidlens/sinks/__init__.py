"""Sinks: CSV folders, single-file CSV, Parquet, metric tables."""

from vidlens.sinks.writers import (csv_ready, metric_table, publish_csv, publish_part, read_csv_reversible, statistics_table, write_csv,
                                   write_csv_reversible, write_parquet, write_single_csv)

__all__ = [n for n in dir() if not n.startswith("_")]
