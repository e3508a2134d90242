"""Read models of the portal: product catalogue, freshness, sales, quality and gate listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodework.operators import governance
from lodework.operators.products import REGISTRY, Product
from lodework.sources.tables import inline


def product_comments(spark: SparkSession, registry: Sequence[Product] = REGISTRY) -> DataFrame:
    return inline(spark, [(p.name.upper(), p.comment) for p in registry], "table_name string, table_comment string")


def product_catalogue(sla: DataFrame, comments: DataFrame) -> DataFrame:
    """Products with freshness and description; names match without regard to case."""
    described = comments.select(F.upper("table_name").alias("_key"), "table_comment")
    return sla.join(described, F.upper("product_name") == F.col("_key"), "left").drop("_key").orderBy("product_name")


def sla_summary(sla: DataFrame) -> DataFrame:
    return sla.groupBy("sla_status").agg(F.count(F.lit(1)).alias("cnt")).orderBy("sla_status")


def product_row_counts(sla: DataFrame) -> DataFrame:
    return sla.select("product_name", "current_row_count", "hours_since_refresh").orderBy(
        F.col("current_row_count").desc(), "product_name")


def monthly_sales(monthly: DataFrame) -> DataFrame:
    """Month totals; customers are summed over territories."""
    return monthly.groupBy("year_month").agg(
        F.sum("total_orders").alias("total_orders"), F.sum("total_revenue").alias("total_revenue"),
        F.sum("unique_customers").alias("unique_customers")).orderBy("year_month")


def dq_log_tail(log: DataFrame, k: int = 100) -> DataFrame:
    return log.orderBy(F.col("log_timestamp").desc(), "target_table").limit(k).select(
        "target_table", "dq_dimension", "check_description", "records_passed", "records_failed", "pass_rate_pct",
        "status", "log_timestamp")


def job_runs_tail(runs: DataFrame, k: int = 50) -> DataFrame:
    return runs.orderBy(F.col("run_at").desc(), "job_name").limit(k).select("job_name", "status", "message", "run_at")


def task_audit_tail(audit: DataFrame, k: int = 20) -> DataFrame:
    return audit.orderBy(F.col("executed_at").desc(), "task_name").limit(k).select(
        "task_name", "product_name", "result_status", "executed_at")


def latest_gates(results: DataFrame) -> DataFrame:
    return governance.latest_run(results).select(
        "gate_id", "gate_name", "status", "actual_value", "expected_value", "details", "evaluated_at",
    ).orderBy("gate_id")
