"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodework import session

# The white space that separates words.
SPACE = "[\\x20\\x09-\\x0D]+"


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the source folder. Python workers import this package from where the driver does."""
    environment = spark.sparkContext.environment
    if _ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), _ROOT]))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage, gives Spark exact sizes."""
    path = f"{session.shared_dir(df.sparkSession).rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Words between the white space of ``SPACE``; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def same(left: DataFrame, right: DataFrame, columns: Iterable[str]) -> Column:
    """Null-safe equality on all ``columns``."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition
