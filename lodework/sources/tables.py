"""Scans of the raw Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The seven raw tables of the sales model.
SALES_TABLES = ("customer", "orders", "lineitem", "part", "supplier", "nation", "region")


def load(spark: SparkSession, source_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{source_dir.rstrip('/')}/{name}.parquet")


def load_all(spark: SparkSession, source_dir: str) -> dict[str, DataFrame]:
    return {name: load(spark, source_dir, name) for name in SALES_TABLES}


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Literal rows as a table (seed metadata, hand-made fixtures)."""
    return spark.createDataFrame(rows, schema)
