"""Distinct orders and customers of the marts, with repeated lines, orders under two customers and NULLs."""

import contextlib
import io
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lodework.operators import marts, products
from tests.conftest import rows

LINES = [  # rep, order, customer, product, line, day, revenue, order total
    (1, 10, 1, 1, "10-1", date(1995, 1, 3), "5.00", "50.00"),
    (1, 10, 1, 2, "10-2", date(1995, 1, 3), None, "50.00"),
    (1, 10, 2, 1, "10-1", date(1995, 1, 3), "5.00", "70.00"),
    (1, 10, 1, 1, "10-1", date(1995, 1, 3), "5.00", "60.00"),
    (1, 11, 1, 1, "11-1", date(1995, 2, 3), "8.00", "20.00"),
    (1, 12, None, 2, "12-1", date(1995, 1, 9), "1.00", None),
    (2, 10, 1, 1, "10-3", date(1995, 1, 3), "2.50", "50.00"),
    (2, 13, 3, 3, "13-1", date(1995, 1, 3), None, "9.00"),
    (None, 14, 3, None, "14-1", date(1995, 1, 3), "1.00", "9.00"),
]


@pytest.fixture(scope="module")
def fact(spark):
    lines = spark.createDataFrame(
        [(r, o, c, p, k, d, v and D(v), t and D(t)) for r, o, c, p, k, d, v, t in LINES],
        "rep_id long, order_id long, customer_id long, product_id long, order_item_key string, date_key date, "
        "revenue decimal(18,2), order_total decimal(18,2)")
    return lines.withColumns({"quantity": F.lit("1.00").cast("decimal(18,2)"), "return_flag": F.lit("N"),
                              "unit_price": F.lit("1").cast("decimal(18,8)"), "territory_id": F.col("rep_id")})


@pytest.fixture(scope="module")
def reps(spark):
    return spark.createDataFrame([(1, "a", "t", "r", D("10.00")), (2, "b", "t", "r", D("10.00"))],
                                 "rep_id long, name string, territory_name string, region string, quota decimal(18,2)")


@pytest.fixture(scope="module")
def stock(spark):
    return spark.createDataFrame([(n, "p", "c", "m", "b", 1.0) for n in (1, 2, 3)],
                                 "product_id long, product_name string, category string, manufacturer string, brand string, unit_price double")


def distinct(df, *keys):
    return df.groupBy(*keys).agg(F.count_distinct("customer_id").alias("c"), F.count_distinct("order_id").alias("o"), F.sum("revenue").alias("v"))


def test_counts(spark, fact, reps, stock):
    named = fact.filter("rep_id is not null").withColumns({"year": F.year("date_key"), "month": F.month("date_key")})
    assert rows(marts.sales_rep_scorecard(fact, reps), "rep_id", "unique_customers", "total_orders", "total_revenue") == rows(
        distinct(named, "rep_id"))
    assert rows(products.sales_rep_monthly_performance(fact, reps), "rep_id", "year", "month", "unique_customers", "orders_closed",
                "revenue_generated") == rows(distinct(named, "rep_id", "year", "month"))
    sold = named.filter("product_id is not null")
    assert rows(marts.product_performance(fact, stock), "product_id", "total_orders", "total_revenue") == rows(
        distinct(sold, "product_id").drop("c"))
    assert rows(products.product_performance_analytics(fact, stock), "product_id", "year", "month", "total_orders", "total_revenue") == rows(
        distinct(sold, "product_id", "year", "month").drop("c"))


def test_order_totals_once(spark, fact):
    """An order's total counts once per month, territory and customer, the greatest of its lines."""
    places = spark.createDataFrame([(1, "x", "r"), (2, "y", "r")], "territory_id long, territory_name string, region string")
    told = rows(marts.monthly_sales_summary(fact, places), "territory_id", "month", "total_orders", "unique_customers",
                "total_line_items", "avg_order_value", "avg_order_value_dedup", "max_order_value", "min_order_value")
    assert told == [
        (1, 1, 2, 2, 5, D("115.00"), D("65.00"), D("70.00"), D("50.00")),
        (1, 2, 1, 1, 1, D("20.00"), D("20.00"), D("20.00"), D("20.00")),
        (2, 1, 2, 2, 2, D("29.50"), D("29.50"), D("50.00"), D("9.00"))]


def test_no_row_is_repeated_to_count(fact, reps, stock):
    """Counting several distinct columns at once repeats every row; one distinct column holds all pairs in hash tables."""
    for df in (marts.sales_rep_scorecard(fact, reps), products.sales_rep_monthly_performance(fact, reps),
               marts.product_performance(fact, stock), products.product_performance_analytics(fact, stock)):
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            df.explain(True)
        assert "Expand" not in plan.getvalue() and "count(distinct" not in plan.getvalue()
