"""Table writes: replace, append, keyed upsert, clustered and lookup-optimised layouts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodework.functions.ranking import By, numbered


def replace(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write as the whole content of a table and return the stored rows."""
    df.write.mode("overwrite").options(partitionOverwriteMode="static", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_numbered(df: DataFrame, path: str, id_column: str, order_by: Sequence[str]) -> DataFrame:
    """Append log rows with ids that continue the stored ones.

    Meant for control tables, where an append is a handful of rows.
    """
    spark = df.sparkSession
    start = 0
    if exists(spark, path):
        start = spark.read.parquet(path).agg(F.max(id_column)).first()[0] or 0
    rest = [c for c in df.columns if c not in order_by]
    shifted = numbered(df, id_column, [By(c) for c in order_by], rest, start=start + 1)
    return append(shifted.select(id_column, *df.columns), path)


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The table in a folder; None without the folder or any file in it. Other failures are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def exists(spark: SparkSession, path: str) -> bool:
    return stored_rows(spark, path) is not None


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], *, update: bool = True) -> DataFrame:
    """Target after a keyed merge: matched rows replaced (or kept), unmatched source rows added.

    ``source`` has at most one row per key.
    """
    if update:
        return target.join(source.select(*keys), list(keys), "left_anti").select(*source.columns).unionByName(source)
    return target.unionByName(source.join(target.select(*keys), list(keys), "left_anti").select(*target.columns))


class VersionedTable:
    """A Parquet table replaced by whole versions.

    A write goes to a new folder and is then entered in a manifest; the newest entry is
    the table. Readers of the previous version are not disturbed, and a job that dies
    midway leaves the table as it was. A version has one entry: of two writers that started
    from the same version, the second fails instead of hiding the first.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.manifest = f"{self.path}/manifest"

    def _latest(self) -> tuple[int, str] | None:
        if not exists(self.spark, self.manifest):
            return None
        newest = self.spark.read.parquet(self.manifest).orderBy(F.col("version").desc()).first()
        return newest["version"], newest["folder"]

    def read(self) -> DataFrame | None:
        latest = self._latest()
        return self.spark.read.parquet(f"{self.path}/{latest[1]}") if latest else None

    def write(self, df: DataFrame) -> DataFrame:
        latest = self._latest()
        version = latest[0] + 1 if latest else 1
        folder = f"version-{version}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        entry = self.spark.createDataFrame([(folder,)], "folder string")
        entry.coalesce(1).write.mode("error").parquet(f"{self.manifest}/version={version}")
        return self.spark.read.parquet(f"{self.path}/{folder}")

    def upsert(self, source: DataFrame, keys: Sequence[str], *, update: bool = True) -> DataFrame:
        current = self.read()
        return self.write(source if current is None else merge(current, source, keys, update=update))


def clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows placed so that files hold narrow key ranges and readers skip by min and max."""
    ranges: list[Column] = [F.col(k) for k in keys]
    return df.repartitionByRange(*ranges).sortWithinPartitions(*ranges)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], lookup: Sequence[str] = ()) -> DataFrame:
    """Clustered write, with Bloom filters on the columns used for point lookups."""
    return replace(clustered(df, keys), path, **bloom_options(lookup))


def bloom_options(columns: Sequence[str]) -> dict[str, str]:
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
