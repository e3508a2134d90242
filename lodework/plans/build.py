"""Materialise the layers in dependency order.

Each layer is written once and the later ones read the stored tables, so a line is
parsed, checked and joined once however many marts use it. Tables of one group do not
depend on each other; their jobs are submitted together so that a small table does not
leave the cluster idle.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodework.operators import bronze, features, silver, sinks
from lodework.operators.features import Spine
from lodework.plans.star import AS_OF, LOADED_AT, SalesModel

# The columns by which two tables are clustered, and those used for point lookups. The last two
# columns of the fact table only let one busy date and territory be many ranges.
CLUSTERED = {"gold.fact_orders": ("date_key", "territory_id", "order_id", "order_item_key"),
             "gold.monthly_sales_summary": ("year", "month", "territory_id")}
LOOKUPS = {"gold.fact_orders": ("customer_id", "product_id", "territory_id", "order_id"),
           "gold.dim_customers": ("customer_id", "nation_key"),
           "gold.dim_products": ("product_id", "category")}

TABLES: dict[str, Callable[[SalesModel], DataFrame]] = {
    **{f"bronze.{t}": (lambda m, t=t: bronze.audit_copy(m.landing[t], t, m.loaded_at))
       for t in ("customers", "orders", "order_items", "products", "sales_reps", "territories")},
    "silver.customers": lambda m: m.customers,
    "silver.territories": lambda m: m.territories,
    "silver.products": lambda m: m.products,
    "silver.sales_reps": lambda m: m.sales_reps,
    "silver.orders": lambda m: m.orders,
    "silver.checked_items": lambda m: m.checked_items,
    "gold.dim_products": lambda m: m.dim_products,
    "gold.dim_sales_reps": lambda m: m.dim_sales_reps,
    "gold.dim_customers": lambda m: m.dim_customers,
    "gold.fact_orders": lambda m: m.fact,
    "gold.monthly_sales_summary": lambda m: m.monthly_sales,
    "gold.customer_sets": lambda m: m.customer_sets,
    "gold.customer_lifetime_value": lambda m: m.lifetime_value,
    "gold.product_performance": lambda m: m.product_performance,
    "gold.sales_rep_scorecard": lambda m: m.scorecard,
    "gold.customer_segmentation": lambda m: m.segmentation,
    "gold.sales_rep_monthly_performance": lambda m: m.rep_monthly,
    "gold.customer_revenue_forecast": lambda m: m.forecast,
    "gold.customer_acquisition_cohort": lambda m: m.cohorts,
    "gold.product_performance_analytics": lambda m: m.product_analytics,
    "features.customer_rfm": lambda m: m.rfm_features,
    "features.customer_engagement": lambda m: m.engagement_features,
    "features.product_performance": lambda m: m.product_features,
    "features.sales_rep_quota": lambda m: m.rep_features,
}

# The groups of each phase, in order; a group reads only the groups before it.
PHASES: dict[str, tuple[tuple[str, ...], ...]] = {
    "bronze": (("bronze.order_items", "bronze.orders", "bronze.customers", "bronze.products", "bronze.sales_reps",
                "bronze.territories"),),
    "silver": (("silver.customers", "silver.products", "silver.sales_reps", "silver.territories"),
               ("silver.orders",), ("silver.checked_items",)),
    "gold": (("gold.fact_orders", "gold.dim_customers", "gold.dim_products", "gold.dim_sales_reps"),
             ("gold.monthly_sales_summary", "gold.product_performance", "gold.sales_rep_scorecard",
              "gold.customer_segmentation", "gold.customer_lifetime_value")),
    "products": (("gold.customer_sets", "gold.sales_rep_monthly_performance", "gold.customer_revenue_forecast",
                  "gold.product_performance_analytics", "gold.customer_acquisition_cohort"),),
    "features": (("features.customer_rfm", "features.product_performance", "features.sales_rep_quota",
                  "features.customer_engagement"),),
}


def run(spark: SparkSession, source_dir: str, target_dir: str, *, as_of: date = AS_OF,
        loaded_at: datetime = LOADED_AT, spine: Spine | None = None, phases: tuple[str, ...] = tuple(PHASES),
        without: Collection[str] = (), on_phase: Callable[[str, float], None] | None = None) -> SalesModel:
    """Write the phases below ``target_dir`` and return the model over the stored tables.

    Tables named in ``without`` are not stored; the model computes them where they are asked for.
    """
    stored: dict[str, DataFrame] = {}
    counted: dict[str, int] = {}

    def model() -> SalesModel:
        return SalesModel(spark, source_dir, as_of=as_of, loaded_at=loaded_at, spine=spine, stored=stored)

    for phase in phases:
        started = time.monotonic()
        for whole in PHASES[phase]:
            group = [name for name in whole if name not in without]
            if not group:
                continue
            current = model()
            with ThreadPoolExecutor(len(group)) as jobs:
                # Bronze rows are numbered over written partitions, so making a table may itself be a job.
                written = {name: jobs.submit(lambda n=name: _write(TABLES[n](current), n, folder(target_dir, n), counted))
                           for name in group}
                stored.update({name: job.result() for name, job in written.items()})
            if "silver.checked_items" in group:
                kept = stored["silver.checked_items"].filter(F.col("is_rejected") == 0)
                stored["silver.order_items"] = silver.accepted(kept)
        # Control rows, one per table.
        counts = spark.createDataFrame(sorted(counted.items()), "table_name string, row_count bigint")
        stored["monitoring.row_counts"] = sinks.replace(counts.coalesce(1), folder(target_dir, "monitoring.row_counts"))
        if on_phase:
            on_phase(phase, time.monotonic() - started)
    return model()


def folder(target_dir: str, name: str) -> str:
    """Where the build keeps a table."""
    return f"{target_dir.rstrip('/')}/{name.replace('.', '/')}"


def _write(df: DataFrame, name: str, path: str, counted: dict[str, int]) -> DataFrame:
    """Write one table, count its rows on the way, and return what is stored."""
    spark, seen = df.sparkSession, Observation(name)
    if name == "silver.checked_items":
        # Accepted and rejected lines lie in separate folders, written by one pass.
        bad = F.col("rejection_reason").isNotNull()
        dealt = df.withColumn("is_rejected", F.when(bad, 1).otherwise(0)).hint("rebalance", "is_rejected")
        _partitioned(dealt.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected")), path, "is_rejected")
        found = seen.get
        counted.update({"silver.order_items": found["rows"] - found["rejected"], "rejected.order_items": found["rejected"]})
        return spark.read.schema(dealt.schema).parquet(path)
    if name.startswith("features."):
        # Readers of one date or range prune to its months.
        df = df.withColumn(features.MONTH, F.date_format("observation_date", "yyyy-MM")).hint("rebalance", features.MONTH)
        _partitioned(_counting(df, seen), path, features.MONTH)
        written = spark.read.schema(df.schema).parquet(path)
    else:
        if name in CLUSTERED:
            df = sinks.clustered(df, CLUSTERED[name])
        written = sinks.replace(_counting(df, seen), path, **sinks.bloom_options(LOOKUPS.get(name, ())))
    counted[name] = seen.get["rows"]
    return written


def _counting(df: DataFrame, seen: Observation) -> DataFrame:
    """Rows counted by the tasks that write them: those of the last stage, whose results count once even if repeated."""
    return df.observe(seen, F.count(F.lit(1)).alias("rows"))


def _partitioned(df: DataFrame, path: str, column: str) -> None:
    """One folder per value; the rebalance before it gives each value few files and splits large ones."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(column).parquet(path)
