"""Scans and sinks: the driver's parquet tables, the derived interaction
table, CSV and parquet files."""

from tastemap.sources.files import (
    RATINGS_SCHEMA,
    materialize,
    repartition_layout,
    read_csv_table,
    read_parquet_table,
    register_views,
    row_count,
    schema_report,
    write_csv_parts,
    write_parquet_table,
    write_single_csv,
    write_single_parquet,
)
from tastemap.sources.interactions import INTERACTIONS_SQL, interactions
from tastemap.sources.tables import load_table

__all__ = [
    "RATINGS_SCHEMA", "INTERACTIONS_SQL", "materialize", "repartition_layout", "interactions", "load_table",
    "read_csv_table", "read_parquet_table", "register_views", "row_count", "schema_report",
    "write_csv_parts", "write_parquet_table", "write_single_csv", "write_single_parquet",
]
