"""Bronze: full copies of the landing tables with audit columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodework.functions import expressions as X
from lodework.functions.ranking import By, numbered

# The order that defines the row number of each table.
ROW_ORDER = {
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "line_number"),
    "products": ("product_id",),
    "sales_reps": ("rep_id",),
    "territories": ("territory_id",),
}


def stamp(df: DataFrame, table: str, loaded_at: datetime) -> DataFrame:
    """The audit columns that need no ordering; a map-only step."""
    return df.withColumns({
        "_loaded_at": X.moment(loaded_at),
        "_source_table": F.lit(f"LANDING.{table.upper()}"),
    })


def audit_copy(df: DataFrame, table: str, loaded_at: datetime) -> DataFrame:
    """The copy with ``_row_number`` in key order, numbered over range partitions.

    Rows with equal keys are told apart by their remaining columns, so the numbering
    is reproducible.
    """
    keys = ROW_ORDER[table]
    rest = [c for c in df.columns if c not in keys]
    return stamp(numbered(df, "_row_number", [By(c) for c in keys], rest), table, loaded_at)


def parity(landing: dict[str, DataFrame], bronze: dict[str, DataFrame]) -> DataFrame:
    """Row counts of both layers, one row per (layer, table)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name.upper()).alias("table_name"), "row_count")
        for layer, tables in (("LANDING", landing), ("BRONZE", bronze))
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def load_profile(df: DataFrame) -> DataFrame:
    """Rows per load time and source table."""
    return df.groupBy("_loaded_at", "_source_table").agg(F.count(F.lit(1)).alias("rows"))
