from datetime import date

import pytest
from pyspark.sql import functions as F

from lodework.operators import bi, features, member_sets, quality, sinks
from lodework.plans import build, queries
from lodework.plans.star import SalesModel
from lodework.sources import footers
from tests.conftest import SMALL, rows

_PHASES = ("bronze", "silver", "gold", "products")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake"))
    return path, build.run(spark, SMALL, path, phases=_PHASES)


def test_counts_of_a_build_are_those_of_its_tables(spark, lake):
    path, model = lake
    counts = {r.table_name: r.row_count for r in model.row_counts.collect()}
    for name, stored in model.stored.items():
        if name in counts:
            assert counts[name] == stored.count(), name
    assert counts["silver.order_items"] + counts["rejected.order_items"] == counts["bronze.order_items"]
    assert {t for g in build.PHASES["products"] for t in g} < set(counts)


def test_log_and_flow_of_a_built_lake_read_no_layer(lake):
    for df in (lake[1].quality_log, lake[1].row_flow):
        plan = plan_of(df)
        assert "row_counts" in plan and "bronze/" not in plan and "silver/" not in plan


def test_raw_log_reads_the_lines_once(spark):
    assert sum("l_orderkey" in x for x in plan_of(SalesModel(spark, SMALL).quality_log).split("\n") if "FileScan" in x) == 1


def test_gates_of_a_built_lake_scan_little(lake):
    scans = lambda m: plan_of(queries.gate_results(m, queries.NOW)).count("FileScan")
    assert scans(lake[1]) < 20


def test_a_build_over_empty_tables_counts_zero(spark, folder):
    raw = f"{folder}/raw"
    for name, df in SalesModel(spark, SMALL).raw.items():
        df.limit(0).write.parquet(f"{raw}/{name}.parquet")
    model = build.run(spark, raw, f"{folder}/lake", phases=("bronze", "silver"))
    assert {r.row_count for r in model.row_counts.collect()} == {0}
    assert [(r.records_passed, r.records_failed) for r in model.quality_log.collect()] == [(0, 0)] * 3


def test_footers_answer_counts_and_bounds(spark, lake):
    path, model = lake
    fact = build.folder(path, "gold.fact_orders")
    found = footers.bounds(spark, fact, ["date_key", "order_id"])
    assert "PushedAggregation: [COUNT(*), MIN(date_key), MAX(date_key), MIN(order_id), MAX(order_id)]" in plan_of(found)
    f = model.fact
    assert found.first() == f.agg(F.count(F.lit(1)), F.min("date_key"), F.max("date_key"), F.min("order_id"), F.max("order_id")).first()
    assert "FileScan parquet" in plan_of(spark.read.parquet(fact))  # other reads keep their reader
    counts = footers.table_counts(spark, {"fact_orders": fact, "dim_products": build.folder(path, "gold.dim_products")})
    assert rows(counts) == rows(quality.table_counts({"fact_orders": f, "dim_products": model.dim_products}))
    empty = sinks.replace(f.limit(0), f"{path}/none")
    assert empty.count() == 0 and footers.bounds(spark, f"{path}/none", ["date_key"]).first() == (0, None, None)


def test_table_health_of_stored_tables(spark, folder):
    days = [date(2000, 1, d) for d in (1, 2, 9)]
    table = spark.createDataFrame([(k, d) for k in (1, 2, None) for d in days], "customer_id long, observation_date date")
    path = f"{folder}/feature"
    table.withColumn("observation_month", F.lit("2000-01")).write.partitionBy("observation_month").parquet(path)
    limits = footers.bounds(spark, path, ["observation_date"])
    assert "PushedAggregation: [COUNT(*), MIN(observation_date)" in plan_of(limits)
    stored = features.table_health_stored({"t": (spark.read.parquet(path), "customer_id", limits)})
    assert rows(stored) == rows(features.table_health({"t": (table, "customer_id")}))


def test_member_sets_count_exactly_at_every_grain(spark):
    """Repeated, negative and very large members, one hot member and NULLs, in cells of several ranges."""
    made = [(m, c, k, 1) for m in range(3) for c in "ab" for k in (0, 1, 32767, 32768, -1, 2**40 + m, 7 * m, None)]
    made += [(0, "a", 5, 1)] * 500 + [(2, "n", None, 1)]
    table = spark.createDataFrame(made, "month int, cell string, member long, amount long")
    sets = member_sets.cells(table, ["month", "cell"], "member", "amount")
    for grain in (["month", "cell"], ["month"], ["cell"], []):
        got = member_sets.count_members(sets, grain, "amount", "n")
        want = table.groupBy(*grain).agg(F.count_distinct("member").alias("n"), F.sum("amount").alias("amount"))
        assert rows(got) == rows(want.select(*got.columns)), grain
    assert member_sets.count_members(sets.limit(0), ["cell"], "amount", "n").count() == 0


def test_sets_are_made_where_their_members_lie(spark):
    table = spark.createDataFrame([(k % 2, k, 1) for k in range(10)], "cell long, member long, amount long")
    plan = plan_of(member_sets.cells(table, ["cell"], "member", "amount"))
    assert plan.count("Exchange hashpartitioning") == 2  # rows to members, members to ranges


def test_stored_sets_answer_months_and_categories(spark, lake):
    model = lake[1]
    assert rows(bi.month_territory_category_of_sets(model.customer_sets, model.dim_territories)) == rows(
        bi.month_territory_category(model.fact, model.dim_territories, model.dim_products))
