"""Sources and sinks: driver Parquet tables, the HR-shaped fixture views, CSV text landing, schemas."""

from cohortlens.sources.tables import read_table, TABLES  # noqa: F401
