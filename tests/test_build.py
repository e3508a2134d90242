from datetime import date

from pyspark.sql import functions as F

from lodework.operators import features, gold, quality
from lodework.operators.features import Spine
from lodework.plans import build
from lodework.plans.star import SalesModel
from tests.conftest import SMALL, rows


def test_stored_layers_equal_the_lazy_model(spark, folder):
    seen = []
    monthly = Spine(step="month")
    phases = ("bronze", "silver", "gold", "features")
    stored = build.run(spark, SMALL, folder, spine=monthly, phases=phases, on_phase=lambda name, _: seen.append(name))
    lazy = SalesModel(spark, SMALL, spine=monthly)
    assert seen == list(phases)
    for name in ("order_items", "fact", "segmentation", "training_customers"):
        left, right = getattr(stored, name), getattr(lazy, name)
        assert rows(left, *right.columns) == rows(right), name
    day = date(1998, 5, 1)
    looked_up = features.customer_features_as_of(stored.training_customers, [1, 2, 3], day)
    assert rows(looked_up) == rows(features.customer_features_as_of(lazy.training_customers, [1, 2, 3], day))
    plan = features.observed_between(stored.rfm_features, day, day)._jdf.queryExecution().executedPlan().toString()
    assert "observation_month" in plan.split("PartitionFilters")[1].split("]")[0]
    assert {r.source: r.total_revenue for r in quality.reconcile(stored.order_items, stored.fact).collect()}.values()


def test_calendar_is_a_filter_that_reaches_the_scan(spark):
    plan = SalesModel(spark, SMALL, calendar=gold.CALENDAR).monthly_sales._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "FileScan" in line and "o_orderdate" in line]
    assert len(scan) == 1 and "DataFilters: [isnotnull(o_orderdate" in scan[0]
    assert ">= 1992-01-01 00:00:00" in plan and "< 2000-01-02 00:00:00" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_the_calendar_covers_all_orders(spark):
    model = SalesModel(spark, SMALL)
    lost = quality.calendar_loss(model.fact, *model.days).first()
    assert lost.lines_outside == 0 and model.spine.end == model.days[1] >= date(2000, 1, 1)
    marts = model.monthly_sales.agg(F.sum("total_revenue")).first()[0]
    assert marts == model.fact.agg(F.sum("revenue")).first()[0]


def test_no_plan_crosses_tables(spark):
    model = SalesModel(spark, SMALL, spine=Spine(step="month"))
    for df in (model.rfm_features, model.engagement_features, model.product_features, model.rep_features,
               model.training_customers, model.lifetime_value, model.segmentation):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_one_hot_customer(spark):
    """A customer with a third of all orders changes nothing but that customer's row."""
    model = SalesModel(spark, SMALL)
    landing = dict(model.landing)
    hot = landing["orders"].withColumn(
        "customer_id", F.when(F.col("order_id") % 3 == 0, 7).otherwise(F.col("customer_id")))
    skewed = SalesModel(spark, SMALL, landing_tables={**landing, "orders": hot})
    total = skewed.dim_customers.agg(F.sum("lifetime_value")).first()[0]
    assert total == model.dim_customers.agg(F.sum("lifetime_value")).first()[0]
    top = skewed.lifetime_value.orderBy(F.col("lifetime_value").desc()).first()
    assert top.customer_id == 7 and top.lifetime_order_count >= 500


def test_a_table_left_out_is_computed_instead(spark, folder):
    stored = build.run(spark, SMALL, folder, phases=("gold",), without=(
        "gold.monthly_sales_summary", "gold.product_performance", "gold.sales_rep_scorecard", "gold.customer_segmentation",
        "gold.customer_lifetime_value"))
    assert "gold.fact_orders" in stored.stored and "gold.monthly_sales_summary" not in stored.stored
    assert stored.fact.count() == SalesModel(spark, SMALL).fact.count()
