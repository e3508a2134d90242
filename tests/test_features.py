from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lodework.operators import features
from lodework.operators.features import Spine
from tests.conftest import rows

FACTS = [  # customer, product, rep, order, line, day, revenue, quantity, flag
    (1, 1, 1, 10, "10-1", date(1995, 2, 28), "100.00", 2, "R"),
    (1, 2, 1, 10, "10-2", date(1995, 2, 28), "50.00", 1, "N"),
    (1, 1, 2, 11, "11-1", date(1996, 2, 28), "70.00", 1, "N"),
    (1, 1, 1, 12, "12-1", date(1996, 2, 29), "30.00", 3, "R"),
    (2, 1, 1, 13, "13-1", date(1994, 6, 1), "20.00", 1, "N"),
    (2, 1, 1, 13, "13-1", date(1994, 6, 1), "20.00", 1, "R"),
    (2, 2, 2, 14, "14-1", date(1996, 12, 31), "10.00", 1, "N"),
    (2, 2, 2, 15, "15-1", date(1997, 1, 1), "15.00", 1, "N"),
]
DAILY = Spine(date(1995, 1, 1), date(1997, 3, 5))
MONTHLY = Spine(date(1995, 1, 1), date(1997, 3, 5), "month")


@pytest.fixture(scope="module")
def fact(spark):
    df = spark.createDataFrame(
        [(c, p, r, o, k, d, D(v), D(q), f) for c, p, r, o, k, d, v, q, f in FACTS],
        "customer_id long, product_id long, rep_id long, order_id long, order_item_key string, date_key date, "
        "revenue decimal(18,2), quantity decimal(18,2), return_flag string")
    return df


def back(day, months=12):
    """The same day ``months`` earlier, at the end of a shorter month."""
    year, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    for last in range(day.day, 0, -1):
        try:
            return date(year, month + 1, last)
        except ValueError:
            continue


def days(spine):
    out, day = [], spine.start
    while day <= spine.end:
        if spine.step == "day" or day.day == 1:
            out.append(day)
        day += timedelta(days=1)
    return out


@pytest.mark.parametrize("spine", [DAILY, MONTHLY])
def test_rfm_equals_brute_force(spark, fact, spine):
    customers = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    found = features.customer_rfm(fact, customers, spine)
    expected = []
    for c in (1, 2, 3):
        for day in days(spine):
            seen = [f for f in FACTS if f[0] == c and f[5] <= day]
            if not seen:
                continue
            window = [f for f in seen if f[5] >= back(day)]
            expected.append((c, day, (day - max(f[5] for f in seen)).days, len({f[3] for f in window}),
                             sum((D(f[6]) for f in window), D(0))))
    got = [(c, d, r, f, m) for c, d, r, f, m in rows(
        found, "customer_id", "observation_date", "recency_days", "frequency_12m", "monetary_12m")]
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("spine", [DAILY, MONTHLY])
def test_products_equal_brute_force(spark, fact, spine):
    products = spark.createDataFrame([(1,), (2,), (3,)], "product_id long")
    found = features.product_performance(fact, products, spine)
    expected = []
    for day in days(spine):
        totals = {}
        for p in (1, 2, 3):
            seen = [f for f in FACTS if f[1] == p and f[5] <= day]
            window = [f for f in seen if f[5] > back(day)]
            totals[p] = (sum((D(f[6]) for f in seen), D(0)), sum((D(f[6]) for f in window), D(0)),
                         sum((D(f[7]) for f in seen), D(0)), sum((D(f[7]) for f in window), D(0)),
                         len({f[4] for f in seen if f[8] == "R"}))
        ranks = sorted({t[0] for t in totals.values()}, reverse=True)
        expected += [(p, day, *t, ranks.index(t[0]) + 1) for p, t in totals.items()]
    got = [tuple(r) for r in found.drop("return_rate_pct").collect()]
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("spine", [DAILY, MONTHLY])
def test_reps_equal_brute_force(spark, fact, spine):
    reps = spark.createDataFrame([(1, D(100)), (2, D(0)), (3, None)], "rep_id long, quota decimal(18,2)")
    found = features.sales_rep_quota(fact, reps, spine).select(
        "rep_id", "observation_date", "ytd_revenue", "cumulative_revenue", "ytd_orders", "ytd_customer_count",
        "quota_attainment_ratio")
    expected = []
    for r, quota in ((1, 100), (2, 0), (3, None)):
        for day in days(spine):
            seen = [f for f in FACTS if f[2] == r and f[5] <= day]
            year = [f for f in seen if f[5].year == day.year]
            ytd = sum((D(f[6]) for f in year), D(0))
            expected.append((r, day, ytd, sum((D(f[6]) for f in seen), D(0)), len({f[3] for f in year}),
                             len({f[0] for f in year}), ytd / quota if quota else None))
    assert sorted(map(tuple, found.collect()), key=lambda t: t[:2]) == sorted(expected, key=lambda t: t[:2])


def test_steps_do_not_multiply_entities(spark, fact):
    customers = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    found = features.customer_rfm(fact, customers, DAILY)
    assert found.count() == found.select("customer_id", "observation_date").distinct().count()


def test_leaving_day():
    from lodework import session
    spark = session.create("tests")
    frame = spark.createDataFrame([(date(2000, 2, 29),), (date(1999, 2, 28),), (date(1999, 8, 31),)], "d date")
    assert [r[0] for r in frame.select(features.reaching(F.col("d"), 12)).collect()] == [
        date(2001, 3, 1), date(2000, 2, 28), date(2000, 8, 31)]


def test_snapshots_and_as_of(spark):
    series = spark.createDataFrame(
        [(1, date(1995, 1, 1), "A"), (1, date(1995, 2, 1), "A"), (1, date(1995, 3, 1), None), (1, date(1995, 4, 1), "B")],
        "customer_id long, observation_date date, segment string")
    snapshots = features.snapshots_from_series(series, "customer_id", "customer", {"seg": "segment"})
    assert rows(snapshots, "feature_value", "valid_from", "valid_to") == [
        ("A", date(1995, 1, 1), date(1995, 3, 1)), ("B", date(1995, 4, 1), None),
        (None, date(1995, 3, 1), date(1995, 4, 1))]
    assert features.feature_as_of(snapshots, "seg", "1", date(1995, 2, 27)).first()[0] == "A"
    assert features.feature_as_of(snapshots, "seg", "1", date(1994, 2, 27)).first()[0] is None
    requests = spark.createDataFrame(
        [("seg", "1", date(1996, 1, 1), 1), ("seg", "1", date(1996, 1, 1), 2), ("seg", "9", date(1996, 1, 1), 3)],
        "feature_id string, entity_key string, as_of_date date, n int")
    assert rows(features.features_as_of(requests, snapshots), "n", "feature_value") == [(1, "B"), (2, "B"), (3, None)]


def test_engagement_starts_with_the_first_order(spark):
    people = spark.createDataFrame(
        [(1, date(1995, 1, 15), date(1995, 3, 1), D(90), 3, 45), (2, None, None, D(0), 0, None),
         (3, date(1999, 1, 1), date(1999, 1, 1), D(1), 1, 0)],
        "customer_id long, first_order_date date, last_order_date date, lifetime_value decimal(28,2), "
        "lifetime_order_count long, customer_tenure_days int")
    found = rows(features.customer_engagement(people, Spine(date(1995, 1, 1), date(1995, 9, 1), "month")),
                 "observation_date", "days_since_last_purchase", "engagement_status")
    assert found[0] == (date(1995, 2, 1), -28, "Active") and len(found) == 8
    assert found[-1] == (date(1995, 9, 1), 184, "Churned")


def test_validation_and_sampling(spark):
    frame = spark.createDataFrame([(1, date(1995, 1, 1)), (None, date(1995, 3, 1))], "customer_id long, observation_date date")
    assert tuple(features.validate_training_data(frame, "customer").first()) == (True, True, False, True)
    with pytest.raises(ValueError):
        features.training_dataset({"customer": frame}, "planet", date(1995, 1, 1), date(1995, 1, 1))
    assert features.training_dataset({"customer": frame}, "customer", date(1995, 1, 1), date(1995, 1, 1)).count() == 1
    big = spark.range(20000).withColumnRenamed("id", "customer_id").withColumn("observation_date", F.lit(date(1995, 1, 1)))
    share = features.training_dataset({"customer": big}, "customer", date(1995, 1, 1), date(1995, 1, 1), 0.1).count()
    assert 1500 < share < 2500


def test_trend_fit_recovers_a_line(spark):
    rows_ = [(1, date(1995, 1, 1) + timedelta(days=31 * i), float(i), float(i * i), 1.0, 2.0 * i + 1) for i in range(12)]
    frame = spark.createDataFrame(rows_ + [(2, date(1995, 1, 1), 1.0, 1.0, 1.0, 1.0)],
                                  "product_id long, observation_date date, revenue_12m double, units_sold_12m double, "
                                  "return_rate_pct double, cumulative_revenue double")
    fitted = features.product_trend_fit(frame).collect()
    assert len(fitted) == 1 and fitted[0].n_rows == 12 and abs(fitted[0].r2 - 1) < 1e-9
    line = features.product_trend(frame).first()
    assert abs(line.slope - 2) < 1e-9 and abs(line.intercept - 3) < 1e-9


def test_importance(spark):
    frame = spark.range(50).select(F.col("id").alias("a"), (-F.col("id") * 2).alias("target"), F.lit("x").alias("text"),
                                   (F.col("id") % 5).alias("noise"))
    found = features.feature_importance(frame, "target").collect()
    assert [r.feature for r in found] == ["a", "noise"] and abs(found[0].correlation_with_target + 1) < 1e-9


def test_products_move_once_by_day_and_once_by_product(spark, fact):
    products = spark.createDataFrame([(1,), (2,)], "product_id long").repartition("product_id")
    lines = features.product_stretches(fact.repartition("order_id"), products, DAILY).rows
    plan = lines._jdf.queryExecution().executedPlan().toString().split("\n")
    moved = [line for line in plan if "Exchange hashpartitioning" in line]
    assert not [line for line in moved if "order_item_key" in line]
    assert len([line for line in moved if "product_id" in line]) == 3  # per day, per product, and the list of products
