"""Driver tables (one Parquet file per table)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Lazy Parquet scan; selecting ``columns`` here makes the pruned ReadSchema explicit."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names: Sequence[str] = TABLES) -> None:
    """Register driver tables as temp views for ``spark.sql`` readers."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
