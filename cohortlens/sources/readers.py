"""Readers: CSV text landing (all strings), SQL reads, missing source -> empty typed frame, projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan_csv_text(spark: SparkSession, path: str, schema: StructType, mode: str = "FAILFAST",
                  multi_line: bool = True) -> DataFrame:
    """CSV with header, every column read as text by the declared (all-string) schema; no inference.

    A quoted field may hold line breaks, quotes doubled and commas, as PostgreSQL's CSV has them. Such a file cannot be
    split, so each file is one task; a large load comes as many files (``path`` may be a folder). Where no field has
    line breaks, ``multi_line=False`` lets Spark split the files.
    """
    return (spark.read.schema(schema).option("header", True).option("mode", mode).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').csv(path))


def sql_read(spark: SparkSession, query: str) -> DataFrame:
    """Run a SQL string over registered views; the result is a lazy DataFrame."""
    return spark.sql(query)


def read_or_empty(spark: SparkSession, path: str | None, schema: StructType, fmt: str = "parquet",
                  table: str | None = None) -> DataFrame:
    """Read a source with the declared columns if it exists, else an empty frame of them."""
    if table is not None:
        if spark.catalog.tableExists(table):
            return spark.table(table)
        return spark.createDataFrame([], schema)
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_project(df: DataFrame, columns: Sequence[str], keep_if_present: bool = False) -> DataFrame:
    """Column subset/reorder; with ``keep_if_present`` absent names are skipped instead of failing."""
    cols = [c for c in columns if c in df.columns] if keep_if_present else list(columns)
    return df.select(*cols)
