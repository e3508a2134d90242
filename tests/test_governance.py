from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lodework.operators import governance, products, reports, sinks
from tests.conftest import rows

NOW = datetime(2024, 6, 1, 12)


def published(spark, **ages):
    return {p.name: spark.range(3).withColumn(
        "_refreshed_at", F.lit(NOW - ages.get(p.name, timedelta(0))).cast("timestamp_ntz")) for p in products.REGISTRY}


def test_sla_bands(spark):
    tables = published(spark, sales_rep_monthly_performance=timedelta(hours=25),
                       customer_revenue_forecast=timedelta(days=51), customer_acquisition_cohort=timedelta(hours=168))
    found = {r.product_name: (r.hours_since_refresh, r.sla_status) for r in governance.sla_status(tables, NOW).collect()}
    assert found == {"sales_rep_monthly_performance": (25, "WARN"), "customer_revenue_forecast": (51, "FAIL"),
                     "customer_acquisition_cohort": (168, "PASS"), "product_performance_analytics": (0, "PASS")}
    left = products.retired("product_performance_analytics")
    assert governance.sla_status(tables, NOW, left).count() == 3


def test_hours_count_boundaries(spark):
    tables = published(spark, sales_rep_monthly_performance=timedelta(minutes=1))
    row = governance.sla_status(tables, NOW, products.registered("sales_rep_monthly_performance")).first()
    assert row.hours_since_refresh == 1


def test_validation(spark):
    reps = spark.createDataFrame([("Active",), ("Away",)], "status string")
    tables = {"orders": spark.range(99), "sales_reps": reps, "dim_customers": spark.range(1000)}
    row = governance.validate_before_refresh("sales_rep_monthly_performance", tables).first()
    assert row.result_status == "FAIL" and row.result_message.split("\n") == [
        "VALIDATION FAILED", "FAIL: Silver orders has 99 rows (min 100 required)", "PASS: 1 active sales reps"]
    assert governance.validate_before_refresh("customer_revenue_forecast", tables).first().result_status == "PASS"
    assert "NO_RULES" in governance.validate_before_refresh("customer_acquisition_cohort", tables).first().result_message


def gates(spark, audit_status="PASS", evidence=True, run_id=1, landing_rows=1):
    some = spark.range(1)
    audit = spark.createDataFrame([(NOW, "PASS"), (NOW, audit_status), (NOW - timedelta(days=8), "FAIL")],
                                  "executed_at timestamp_ntz, result_status string")
    return governance.gates(
        spark, landing={t.lower(): spark.range(landing_rows) for t in governance.LANDING_TABLES}, job_runs=some,
        task_audit=audit, dq_log=some, silver_items=some, metadata_names=governance.METADATA_TABLES,
        sla=governance.sla_status(published(spark), NOW),
        manual_checks=governance.manual_check_row(spark, evidence, "ann", NOW, "note"), now=NOW, run_id=run_id)


def test_gates(spark):
    assert {r.gate_id: r.status for r in gates(spark).collect()} == dict.fromkeys(
        ["A1", "A2", "B4", "B5", "C1", "C2", "C3", "D1", "D2", "E1", "F2"], "PASS")
    failed = {r.gate_id for r in gates(spark, "FAIL", False, landing_rows=0).collect() if r.status == "FAIL"}
    assert failed == {"A2", "B5", "E1"}


def test_no_recent_run_fails(spark):
    audit = spark.createDataFrame([], "executed_at timestamp_ntz, result_status string")
    found = {r.gate_id: (r.status, r.actual_value) for r in governance.gates_task_audit(audit, NOW).collect()}
    assert found == {"B5": ("FAIL", None), "F2": ("FAIL", "0")}


def test_release_decision_reads_the_newest_run(spark):
    results = gates(spark, "FAIL").unionByName(gates(spark, run_id=2))
    row = governance.release_decision(results).first()
    assert (row.run_id, row.release_status, row.pass_count, row.fail_count) == (2, "PASS", 11, 0)
    assert governance.next_run_id(results) == 3
    assert reports.latest_gates(results).count() == 11


def test_manual_check_is_seeded_once_and_marked(spark, folder):
    table = sinks.VersionedTable(spark, folder)
    seed = governance.manual_check_row(spark, False, "system", NOW, governance.SEED_NOTE)
    table.upsert(seed, ["check_name"], update=False)
    table.upsert(governance.manual_check_row(spark, True, "ann", NOW, governance.PASS_NOTE), ["check_name"])
    table.upsert(seed, ["check_name"], update=False)
    assert rows(table.read(), "check_value", "notes") == [(True, governance.PASS_NOTE)]


def test_catalogue_matches_without_case(spark):
    sla = governance.sla_status(published(spark), NOW)
    assert reports.product_catalogue(sla, reports.product_comments(spark)).filter("table_comment IS NULL").count() == 0


def test_freshness_from_counts_equals_that_of_the_tables(spark):
    now, old = datetime(2025, 1, 1, 12), datetime(2024, 12, 20)
    sizes = dict(zip([p.name for p in products.REGISTRY], (3, 0, 1, 2)))
    times = {name: old if n == 1 else now for name, n in sizes.items()}
    tables = {name: spark.range(n).withColumn("_refreshed_at", F.lit(times[name]).cast("timestamp_ntz")) for name, n in sizes.items()}
    counts = spark.createDataFrame(list(sizes.items()), "table_name string, row_count long")
    assert rows(governance.sla_of_counts(counts, times, now)) == rows(governance.sla_status(tables, now))
