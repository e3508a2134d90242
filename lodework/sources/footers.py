"""Row counts and bounds of stored tables, answered by the footers of their Parquet files.

The DataSource V2 Parquet reader turns a global ``count``, ``min`` and ``max`` over plain
columns into a read of file footers: no row group is opened, so the cost follows the
number of files. Strings, decimals and timestamps have no usable bounds there, and a
filter on anything but a partition column makes it an ordinary scan, with the same result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodework.operators.quality import union_all

_V1 = "spark.sql.sources.useV1SourceList"
_PUSHDOWN = "spark.sql.parquet.aggregatePushdown"


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The stored table through the reader that can push aggregates down; other reads keep theirs."""
    # The reader is chosen when the table is opened, the push-down when the query is planned.
    before = spark.conf.get(_V1)
    spark.conf.set(_PUSHDOWN, "true")
    spark.conf.set(_V1, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(_V1, before)


def bounds(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """One row: ``row_count`` and, per column, ``<column>_min`` and ``<column>_max``."""
    limits = [f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    found = scan(spark, path).agg(F.count(F.lit(1)).alias("row_count"), *limits)
    # Pushed counts are added up, and without any row group there is nothing to add: the one row then holds NULL
    # in a column that cannot be NULL by its type. The maximum over that row has the right type.
    kept = found.agg(*[F.max(c).alias(c) for c in found.columns])
    return kept.withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))


def table_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """One row per table with its number of rows."""
    return union_all([bounds(spark, path).select(F.lit(name).alias("table_name"), "row_count") for name, path in paths.items()])
