"""Freshness, pre-refresh validation, audit and release gates.

Every check is a lazy one-row DataFrame; a report is their union.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodework.functions import expressions as X
from lodework.operators import sinks
from lodework.operators.products import REGISTRY, Product
from lodework.operators.quality import count_rows, union_all

# --- freshness ----------------------------------------------------------------------------------


def sla_status(tables: Mapping[str, DataFrame], now: datetime, registry: Sequence[Product] = REGISTRY,
               *, warn_level: bool = True) -> DataFrame:
    """Age, status and rows of each registered product, from one aggregate per product.

    ``hours_since_refresh`` holds days for products measured in days; ``age_unit`` says which.
    """
    return union_all([_judged(tables[product.name].agg(
        F.max("_refreshed_at").alias("last_refreshed_at"), F.count(F.lit(1)).alias("current_row_count")),
        product, now, warn_level) for product in registry])


def sla_of_counts(counts: DataFrame, refreshed_at: Mapping[str, datetime] | datetime, now: datetime,
                  registry: Sequence[Product] = REGISTRY) -> DataFrame:
    """``sla_status`` of products refreshed at known times, from their counts (``table_name, row_count``)."""
    def measured(name: str) -> DataFrame:
        at = refreshed_at[name] if isinstance(refreshed_at, Mapping) else refreshed_at
        return counts.filter(F.col("table_name") == name).select(
            F.when(F.col("row_count") > 0, X.moment(at)).alias("last_refreshed_at"), F.col("row_count").alias("current_row_count"))
    return union_all([_judged(measured(product.name), product, now, True) for product in registry])


def _judged(measured: DataFrame, product: Product, now: datetime, warn_level: bool) -> DataFrame:
    at, last = X.moment(now), F.col("last_refreshed_at")
    age = X.hours_between_boundaries(last, at) if product.age_unit == "HOUR" else F.datediff(at, last)
    status = F.when(F.col("hours_since_refresh") <= product.pass_age, "PASS")
    if warn_level:
        status = status.when(F.col("hours_since_refresh") <= product.warn_age, "WARN")
    return measured.withColumn("hours_since_refresh", age.cast("bigint")).select(
        F.lit(product.name).alias("product_name"),
        F.lit(product.owner).alias("owner"),
        F.lit(product.frequency).alias("refresh_frequency"),
        "last_refreshed_at", "hours_since_refresh",
        F.lit(product.age_unit).alias("age_unit"),
        status.otherwise("FAIL").alias("sla_status"),
        "current_row_count",
    )


# --- validation before a refresh ------------------------------------------------------------------

# Per product the checked table, its row filter, the least number of rows, and the messages.
VALIDATION_RULES = {
    "sales_rep_monthly_performance": (
        ("orders", None, 100, "Silver orders has {} rows", "Silver orders has {} rows (min 100 required)"),
        ("sales_reps", "status = 'Active'", 1, "{} active sales reps", "No active sales reps found"),
    ),
    "customer_revenue_forecast": (
        ("dim_customers", None, 1000, "dim_customers has {} rows", "dim_customers has only {} rows (min 1000 required)"),
    ),
}


def validate_before_refresh(product: str, tables: Mapping[str, DataFrame], rules=VALIDATION_RULES) -> DataFrame:
    """One row: the product, PASS or FAIL, and a message with one line per rule.

    A product without rules passes and says so.
    """
    checks = []
    for position, (table, where, least, good, bad) in enumerate(rules.get(product, ())):
        df = tables[table].filter(where) if where else tables[table]
        enough = F.col("n") >= least
        checks.append(count_rows(df, "n").select(
            F.lit(position).alias("position"),
            enough.alias("ok"),
            F.when(enough, _message("PASS: " + good)).otherwise(_message("FAIL: " + bad)).alias("line"),
        ))
    if not checks:
        spark = next(iter(tables.values())).sparkSession
        return spark.range(1).select(
            F.lit(product).alias("product_name"), F.lit("PASS").alias("result_status"),
            F.lit("VALIDATION PASSED\nNO_RULES").alias("result_message"))
    # As many rows as the product has rules.
    listed = union_all(checks).agg(
        F.bool_and("ok").alias("ok"), F.array_sort(F.collect_list(F.struct("position", "line"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda entry: entry["line"]), "\n")
    return listed.select(
        F.lit(product).alias("product_name"),
        F.when(F.col("ok"), "PASS").otherwise("FAIL").alias("result_status"),
        F.concat(F.when(F.col("ok"), "VALIDATION PASSED\n").otherwise("VALIDATION FAILED\n"), text)
        .alias("result_message"),
    )


def _message(text: str) -> Column:
    before, found, after = text.partition("{}")
    return F.concat(F.lit(before), F.col("n").cast("string"), F.lit(after)) if found else F.lit(text)


def run_product_validation(product: str, task: str, tables: Mapping[str, DataFrame], now: datetime) -> DataFrame:
    """The audit row of one validation run."""
    return validate_before_refresh(product, tables).select(
        F.lit(task).alias("task_name"), "product_name", X.moment(now).alias("executed_at"),
        "result_status", "result_message")


def runs_per_day(log: DataFrame, at: str, *keys: str) -> DataFrame:
    """Runs per day and keys of an audit or job log."""
    return log.groupBy(F.date_trunc("day", at).alias("run_day"), *keys).agg(F.count(F.lit(1)).alias("runs"))


# --- release gates --------------------------------------------------------------------------------

# The tables whose presence is required.
LANDING_TABLES = ("CUSTOMERS", "ORDERS", "ORDER_ITEMS", "PRODUCTS", "SALES_REPS", "TERRITORIES")
METADATA_TABLES = ("AI_SEMANTIC_METADATA", "AI_RETRIEVAL_INDEX_STUB", "AI_RAG_QUERY_PATH_STUB")
GATED_PRODUCTS = ("sales_rep_monthly_performance", "customer_revenue_forecast", "customer_acquisition_cohort")
MANUAL_CHECK = "marketplace_consumer_test_passed"


def _gate(gate_id: str, name: str, passed: Column, actual: Column, expected: str, details: str | Column) -> Column:
    return F.struct(
        F.lit(gate_id).alias("gate_id"), F.lit(name).alias("gate_name"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        actual.cast("string").alias("actual_value"), F.lit(expected).alias("expected_value"),
        (F.lit(details) if isinstance(details, str) else details).alias("details"))


def _rows(measured: DataFrame, *gates: Column) -> DataFrame:
    """The gates that read the same one-row measurement, from one evaluation of it."""
    return measured.select(F.inline(F.array(*gates)))


def _present(spark: SparkSession, names, required) -> DataFrame:
    found = {n.upper() for n in names}
    return spark.range(1).select(F.lit(sum(r in found for r in required)).alias("n"))


def _least_rows(tables: Sequence[DataFrame]) -> DataFrame:
    return union_all([count_rows(df, "n") for df in tables]).agg(F.min("n").alias("n"))


def _min_gate(gate_id: str, name: str, details: str, least: str = "n") -> Column:
    n = F.col(least)
    return _gate(gate_id, name, n > 0, F.concat(F.lit("MIN="), n.cast("string")), "MIN > 0", details)


def _some_rows(gate_id: str, name: str, details: str, expected: str = ">= 1", count: str = "n") -> Column:
    return _gate(gate_id, name, F.col(count) >= 1, F.col(count), expected, details)


# Fixed values in the functions below: gate ids, names, expected values and details.

def gate_landing_present(spark: SparkSession, landing: Mapping[str, DataFrame]) -> DataFrame:
    return _rows(_present(spark, landing, LANDING_TABLES), _gate(
        "A1", "LANDING required tables present", F.col("n") == 6, F.col("n"), "6",
        "Required LANDING tables: " + ", ".join(LANDING_TABLES)))


def gate_landing_filled(landing: Mapping[str, DataFrame], counts: DataFrame | None = None) -> DataFrame:
    measured = _least_rows(list(landing.values())) if counts is None else counts.filter(
        F.col("table_name").isin([f"bronze.{t}" for t in landing])).agg(F.min("row_count").alias("n"))
    return _rows(measured, _min_gate(
        "A2", "LANDING row counts non-zero", "All core LANDING tables must contain data"))


def gate_job_telemetry(job_runs: DataFrame) -> DataFrame:
    return _rows(count_rows(job_runs, "n"), _some_rows(
        "B4", "Job telemetry present", "Expected at least one row in job_runs"))


def gates_task_audit(audit: DataFrame, now: datetime, days: int = 7, least_pct: int = 95) -> DataFrame:
    """Success rate of the last days and presence of any run."""
    recent = F.col("executed_at") >= X.moment(now - timedelta(days=days))
    measured = audit.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(recent).alias("runs"),
        F.count_if(recent & (F.col("result_status") == "PASS")).alias("passed"),
    ).withColumn("rate", X.share_pct(F.col("passed"), F.col("runs")))
    return _rows(
        measured,
        _gate("B5", "Monitoring task success rate (7d)", F.col("rate") >= least_pct, F.col("rate"),
              f">= {least_pct}", "Success rate over last 7 days from MONITORING.task_run_audit"),
        _some_rows("F2", "Task audit telemetry present",
                   "Expected at least one row in task_run_audit after validation runs"))


def gate_quality_log(log: DataFrame) -> DataFrame:
    return _rows(count_rows(log, "n"), _some_rows(
        "C1", "DQ log populated", "Expected DQ check records in monitoring log"))


def gate_silver_items(items: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    measured = count_rows(items, "n") if counts is None else counts.filter(
        F.col("table_name") == "silver.order_items").select(F.col("row_count").alias("n"))
    return _rows(measured, _some_rows(
        "C2", "Silver order_items populated", "Core trusted fact grain must exist in Silver", expected="> 0"))


def gate_metadata_present(spark: SparkSession, names) -> DataFrame:
    return _rows(_present(spark, names, METADATA_TABLES), _gate(
        "C3", "AI-ready artifacts present", F.col("n") == 3, F.col("n"), "3",
        "Expected: " + ", ".join("GOLD." + t.lower() for t in METADATA_TABLES)))


def gates_products(sla: DataFrame) -> DataFrame:
    """Freshness of all products and rows of the gated ones, both read off the SLA rows."""
    gated = F.col("product_name").isin(list(GATED_PRODUCTS))
    measured = sla.agg(
        F.count_if(F.col("sla_status") != "PASS").alias("late"),
        F.min(F.when(gated, F.col("current_row_count"))).alias("least"))
    return _rows(
        measured,
        _gate("D1", "SLA status all PASS", F.col("late") == 0, F.col("late"), "0",
              "Rows in product_sla_status where SLA_STATUS <> PASS"),
        _min_gate("D2", "All three data products populated", ", ".join(GATED_PRODUCTS), "least"))


def gate_manual(checks: DataFrame, name: str = MANUAL_CHECK) -> DataFrame:
    return _rows(checks.filter(F.col("check_name") == name), _gate(
        "E1", "Marketplace consumer test evidence", F.col("check_value"),
        F.when(F.col("check_value"), "TRUE").otherwise("FALSE"), "TRUE",
        F.coalesce("notes", F.lit("Manual evidence required"))))


def gates(spark: SparkSession, *, landing, job_runs, task_audit, dq_log, silver_items, metadata_names, sla,
          manual_checks, now: datetime, run_id: int = 1, counts: DataFrame | None = None) -> DataFrame:
    """All gates of one run; with the ``counts`` of a build (``table_name, row_count``) its tables are not read for them."""
    results = union_all([
        gate_landing_present(spark, landing),
        gate_landing_filled(landing, counts),
        gate_job_telemetry(job_runs),
        gates_task_audit(task_audit, now),
        gate_quality_log(dq_log),
        gate_silver_items(silver_items, counts),
        gate_metadata_present(spark, metadata_names),
        gates_products(sla),
        gate_manual(manual_checks),
    ])
    return results.select(F.lit(run_id).cast("bigint").alias("run_id"), "*",
                          X.moment(now).alias("evaluated_at"))


def next_run_id(results: DataFrame) -> int:
    return (results.agg(F.max("run_id")).first()[0] or 0) + 1


def append_run(results: DataFrame, path: str) -> DataFrame:
    """Append one evaluation to the stored history under the next number, and return the history.

    Meant for one writer at a time, as a release has one; the number is taken from the store.
    """
    spark = results.sparkSession
    stored = sinks.stored_rows(spark, path)
    run_id = next_run_id(stored) if stored is not None else 1
    return sinks.append(results.withColumn("run_id", F.lit(run_id).cast("bigint")), path)


def decisions(results: DataFrame) -> DataFrame:
    """PASS or FAIL with the counts, for every run."""
    return results.groupBy("run_id").agg(
        F.count_if(F.col("status") == "PASS").alias("pass_count"),
        F.count_if(F.col("status") == "FAIL").alias("fail_count"),
        F.min("evaluated_at").alias("evaluated_at"),
    ).select("run_id", F.when(F.col("fail_count") == 0, "PASS").otherwise("FAIL").alias("release_status"),
             "pass_count", "fail_count", "evaluated_at")


def release_decision(results: DataFrame) -> DataFrame:
    """The decision of the newest run."""
    return decisions(results).orderBy(F.col("run_id").desc()).limit(1)


def latest_run(history: DataFrame) -> DataFrame:
    """Rows of the newest run of a stored history, found by its greatest number."""
    return history.filter(F.col("run_id") == history.select(F.max("run_id")).scalar())


# --- manual evidence ------------------------------------------------------------------------------

MANUAL_SCHEMA = ("check_name string, check_value boolean, last_updated_at timestamp_ntz, updated_by string, "
                 "notes string")
# The notes written with the manual check.
SEED_NOTE = "Set CHECK_VALUE=TRUE only after a real consumer account can discover, subscribe, and query."
PASS_NOTE = "Validated from external consumer account."


def manual_check_row(spark: SparkSession, value: bool, user: str, now: datetime, note: str,
                     name: str = MANUAL_CHECK) -> DataFrame:
    return spark.createDataFrame([(name, value, now, user, note)], MANUAL_SCHEMA)
