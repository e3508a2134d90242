"""Stretches say what the days say: every summary over stretches equals the one over the daily table."""

import re
from datetime import date

from pyspark.sql import functions as F

from lodework.operators import features, stretches
from lodework.operators.features import Spine
from lodework.plans.queries import per_month, portable
from tests.conftest import rows
from tests.test_features import D, fact  # noqa: F401

SPINE = Spine(date(1995, 1, 1), date(1996, 4, 5))


def rounded(df):
    return rows(df.select(*[F.round(F.col(n).cast("double"), 6).alias(n) if t in ("double",) else F.col(n) for n, t in df.dtypes]))


def test_customers(spark, fact):  # noqa: F811
    customers = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    dims = spark.createDataFrame(
        [(1, "A", "EU", date(1995, 2, 28), date(1996, 2, 29), D("250.00"), 3, 366),
         (2, "B", "AS", date(1995, 3, 5), date(1997, 1, 1), D("45.00"), 4, 945)],
        "customer_id long, segment string, region string, first_order_date date, last_order_date date, "
        "lifetime_value decimal(28,2), lifetime_order_count long, customer_tenure_days int")
    orders = fact.select("customer_id", F.col("date_key").alias("order_date")).distinct()
    made = features.rfm_stretches(fact, customers, SPINE)
    rfm = made.of(made.rows.localCheckpoint())
    daily = rfm.daily("customer_id").localCheckpoint()
    assert daily.count() == daily.select("customer_id", "observation_date").distinct().count() > rfm.rows.count()
    assert rounded(stretches.per_month(rfm, "customer_id")) == rounded(per_month(daily, "customer_id"))
    some = (date(1995, 5, 10), date(1995, 6, 20))
    assert rows(features.rfm_stretches(fact, customers, SPINE, between=some).daily("customer_id")) == rows(
        features.observed_between(daily, *some))
    told = {"seg": "estimated_segment", "freq": "frequency_12m"}
    assert rows(features.snapshots_from_stretches(rfm, "customer_id", "customer", told)) == rows(
        features.snapshots_from_series(daily, "customer_id", "customer", told))
    made = features.training_stretches(rfm, dims)
    training = made.of(made.rows.localCheckpoint())
    whole = features.training_data_customers(daily, dims).localCheckpoint()
    assert rows(training.daily("customer_id").select(*whole.columns)) == rows(whole)
    present = features.training_presence(features.rfm_presence(fact, SPINE), dims)
    assert rows(features.training_availability({"customer": present})) == rows(features.training_availability({"customer": whole}))
    assert rows(features.validate_stretches(present, "customer")) == rows(features.validate_training_data(whole, "customer"))
    assert rounded(features.importance_of_stretches(training, "lifetime_value")) == rounded(
        features.feature_importance(whole, "lifetime_value"))
    label = features.churn_label(whole, orders, SPINE).select("customer_id", "observation_date", "churned_30_days")
    assert rounded(stretches.per_month(features.churn_stretches(present, orders).in_months(), "customer_id")) == rounded(
        per_month(label, "customer_id"))
    recipe = (date(1995, 4, 1), date(1995, 7, 31))
    assert rounded(stretches.per_month(features.churn_recipe_stretches(training, *recipe), "customer_id")) == rounded(
        per_month(features.churn_recipe(whole, *recipe), "customer_id"))
    assert rows(features.existing_stretches(rfm, dims).select("customer_id").daily("customer_id")) == rows(
        features.existing_only(daily, dims).select("customer_id", "observation_date"))


def test_products(spark, fact):  # noqa: F811
    products = spark.createDataFrame([(1,), (2,), (3,)], "product_id long")
    made = features.product_stretches(fact, products, SPINE)
    held = made.of(made.rows.localCheckpoint())
    daily = features.product_performance(fact, products, SPINE).localCheckpoint()
    assert rows(held.daily("product_id")) == rows(daily.drop("revenue_rank"))
    some = (date(1996, 2, 20), date(1996, 3, 10))
    assert rows(features.ranked_products(held, *some).daily("product_id")) == rows(features.observed_between(daily, *some))
    above = features.observed_between(daily, *some).filter(F.col("cumulative_revenue") > 55)
    assert rows(features.ranked_products(held, *some, 55).daily("product_id")) == rows(above)
    present = features.product_presence(fact, products, SPINE)
    assert rows(features.training_availability({"product": present})) == rows(features.training_availability({"product": daily}))
    assert rows(features.staleness([present], date(2000, 1, 1))) == rows(features.staleness([daily], date(2000, 1, 1)))
    assert rows(features.volume_health([present])) == rows(features.volume_health([daily]))
    assert rounded(features.trend_of_stretches(held)) == rounded(features.product_trend(daily))
    assert rounded(features.trend_fit_of_stretches(held)) == rounded(features.product_trend_fit(daily))


def test_products_per_month(spark, fact):  # noqa: F811
    """Ranks of every day from cells of month and interval equal those of the daily table, with equal values and copies of a product."""
    products = spark.createDataFrame([(n,) for n in range(1, 7)], "product_id long")
    attributes = spark.createDataFrame(
        [(n, "A", None, float(n)) for n in (1, 1, 2, 3, 4, 5, 6)],
        "product_id long, category string, manufacturer string, unit_price double")
    some = fact.unionByName(fact.withColumn("product_id", F.lit(5).cast("bigint")))
    made = features.product_stretches(some, products, SPINE)
    daily = features.product_performance(some, products, SPINE).localCheckpoint()
    for resolution in (1, 16):
        assert rows(portable(features.ranked_products_per_month(made, resolution=resolution))) == rows(
            portable(per_month(daily, "product_id")))
    shown = made.of(features.training_data_products(made.rows, attributes))
    told = features.ranked_products_per_month(made, shown)
    assert rows(portable(told)) == rows(portable(
        per_month(features.training_data_products(daily, attributes), "product_id")))


def test_representatives(spark, fact):  # noqa: F811
    """Every representative has a row on every date, sold or not, repeated or not."""
    reps = spark.createDataFrame([(1, D("100.00")), (2, D("50.00")), (7, None), (7, None)], "rep_id long, quota decimal(18,2)")
    told = {"reps": (features.rep_presence(reps, SPINE), "rep_id")}
    assert rows(features.table_health_of(told)) == rows(features.table_health(
        {"reps": (features.sales_rep_quota(fact, reps, SPINE), "rep_id")}))


def test_cuts_infer_no_condition(spark):
    """A cut adds no condition on its days to the plan: conditions multiply in every later step, and planning did not end."""
    rows_ = spark.createDataFrame([(1, 5, date(1995, 1, 1), date(1995, 3, 1))], "customer_id long, recency_days int, _from date, _until date")
    made = stretches.Stretches(rows_, SPINE, ("recency_days",)).cut(F.array(F.date_add("_from", 3), F.lit(None).cast("date")))
    assert "size(" not in made.rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows(made.rows) == [(1, 5, date(1995, 1, 1), date(1995, 1, 3)), (1, 8, date(1995, 1, 4), date(1995, 3, 1))]


def test_stretches_without_a_first_day_are_left_out(spark):
    rows_ = spark.createDataFrame([(1, None, SPINE.start, SPINE.end), (2, date(1996, 4, 4), SPINE.start, SPINE.end)],
                                  "customer_id long, first date, _from date, _until date")
    assert rows(stretches.Stretches(rows_, SPINE).since(F.col("first")).rows, "customer_id", "_from") == [(2, date(1996, 4, 4))]


def test_cut_at_columns_equals_cut_at_an_array(spark):
    rows_ = spark.createDataFrame(
        [(1, 5, SPINE.start, SPINE.end, date(1995, 3, 1), None), (2, 7, SPINE.start, SPINE.start, date(1995, 3, 1), SPINE.start),
         (3, None, SPINE.start, SPINE.end, SPINE.end, SPINE.end), (4, 1, SPINE.start, SPINE.end, date(1996, 1, 1), date(1995, 2, 2))],
        "customer_id long, recency_days int, _from date, _until date, a date, b date")
    made = stretches.Stretches(rows_, SPINE, ("recency_days",))
    assert rows(made.cut("a", "b").rows) == rows(made.cut(F.array("a", "b")).rows)


def test_months_of_known_texts_are_summed_without_a_sort(spark, fact):  # noqa: F811
    customers = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    made = features.rfm_stretches(fact, customers, SPINE)
    kept = made.of(made.rows.localCheckpoint())
    told = features.customers_per_month(kept)
    assert rounded(told) == rounded(stretches.per_month(kept, "customer_id")) == rounded(per_month(kept.daily("customer_id"), "customer_id").select(*told.columns))
    assert "SortAggregate" not in told._jdf.queryExecution().executedPlan().toString()


def test_score_limits_deal_no_value_of_a_whole_month(spark, fact):  # noqa: F811
    customers = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    plan = features.rfm_stretches(fact, customers, SPINE).rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(axis#" in plan
    # Values are dealt inside the finest interval that holds a limit.
    assert not re.search(r"hashpartitioning\(axis#\d+, _month#\d+, value#\d+, \d+\)", plan)
