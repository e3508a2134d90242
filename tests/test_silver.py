from datetime import date, datetime

import pytest

from lodework.operators import quality, silver
from tests.conftest import rows

OLD, NEW = datetime(2024, 1, 1), datetime(2024, 6, 1)
AS_OF = date(2024, 12, 31)
ITEM_SCHEMA = ("order_item_id string, order_id long, product_id long, supplier_id long, line_number long, "
               "quantity decimal(18,2), unit_price decimal(18,8), line_total decimal(18,2), discount_rate decimal(5,2), "
               "return_flag string, line_status string, ship_date date, commit_date date, receipt_date date, "
               "ship_mode string")


def line(item, order=1, product=1, quantity=10, price=5, total=None, discount=0):
    from decimal import Decimal as D
    if total is None:
        total = (quantity or 0) * (price or 0) * (1 - D(str(discount or 0)))
    number = lambda v: None if v is None else D(str(v))
    return (item, order, product, 1, 1, number(quantity), number(price), number(total), number(discount),
            "N", "O", None, None, None, None)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([
        line("good"), line("no discount", discount=None), line(None), line("no order key", order=None),
        line("no quantity", quantity=None, total=5), line("zero quantity", quantity=0, total=5),
        line("negative price", price=-1, total=5), line("zero total", total=0),
        line("off by five", total=55), line("off by one", total=51), line("just inside", total="50.99"),
        line("unknown order", order=99), line("unknown product", product=99), line("no product", product=None),
        line("twice"), line("twice", quantity=0, total=5),
    ], ITEM_SCHEMA)


@pytest.fixture(scope="module")
def checked(spark, items):
    orders = spark.createDataFrame([(1,), (1,), (2,)], "order_id long")
    products = spark.createDataFrame([(1,), (2,)], "product_id long")
    return silver.checked_items(items, orders, products)


def test_reasons_in_order(checked):
    assert rows(silver.rejected(checked), "order_item_id", "rejection_reason") == sorted([
        ("no order key", silver.NO_ORDER_ID), ("no quantity", silver.BAD_QUANTITY),
        ("zero quantity", silver.BAD_QUANTITY), ("negative price", silver.BAD_PRICE), ("zero total", silver.BAD_TOTAL),
        ("off by five", silver.BAD_MATH), ("off by one", silver.BAD_MATH), ("unknown order", silver.NO_ORDER),
        ("unknown product", silver.NO_PRODUCT), ("no product", silver.NO_PRODUCT_ID), ("twice", silver.BAD_QUANTITY),
    ]) + [(None, silver.NO_ITEM_ID)]


def test_accepted_and_rejected_partition_the_input(items, checked):
    assert silver.accepted(checked).count() + silver.rejected(checked).count() == items.count()


def test_accepted_equals_the_filter(spark, items, checked):
    orders = spark.createDataFrame([(1,), (2,)], "order_id long")
    products = spark.createDataFrame([(1,), (2,)], "product_id long")
    assert rows(silver.accepted(checked)) == rows(silver.order_items(items, orders, products))
    assert [r[0] for r in rows(silver.accepted(checked))] == ["good", "just inside", "no discount", "twice"]


def test_key_based_rejection(checked):
    found = dict(rows(silver.rejected_by_key(checked), "order_item_id", "rejection_reason"))
    assert None not in found and "twice" not in found
    assert found["no product"] == silver.UNKNOWN_REASON


def test_generic_reason(spark, items):
    keys = spark.createDataFrame([(1,)], "k long")
    checked = silver.checked_items(items, keys.withColumnRenamed("k", "order_id"),
                                   keys.withColumnRenamed("k", "product_id"), separate_fk_reasons=False)
    assert silver.GENERIC_FK_REASON in [r[0] for r in rows(checked, "rejection_reason")]


def test_customers(spark):
    raw = spark.createDataFrame([(None, " x ", NEW), (1, "old", OLD), (1, " building ", NEW), (2, None, OLD)],
                                "customer_id long, segment string, _loaded_at timestamp_ntz")
    assert rows(silver.customers(raw)) == [(1, "BUILDING"), (2, None)]


def test_products(spark):
    raw = spark.createDataFrame([
        (1, None, "A", OLD), (2, 0.0, "A", OLD), (3, 1.0, "", OLD), (4, 1.0, None, OLD), (5, 1.0, " tin ", OLD),
        (5, 2.0, "old", datetime(2023, 1, 1))],
        "product_id long, unit_price double, category string, _loaded_at timestamp_ntz")
    assert rows(silver.products(raw), "product_id", "category") == [(3, "UNKNOWN"), (4, "UNKNOWN"), (5, "TIN")]


def test_sales_reps(spark):
    raw = spark.sql("""SELECT * FROM VALUES (1L, -5.00BD, 'Away'), (2L, CAST(NULL AS DECIMAL(18,2)), NULL), (3L, 7.00BD, NULL)
                       AS t(rep_id, quota, status)""")
    found = [(i, None if q is None else float(q), s) for i, q, s in rows(silver.sales_reps(raw))]
    assert found == [(1, 0.0, "Away"), (2, None, "Active"), (3, 7.0, "Active")]


def test_territories(spark):
    raw = spark.createDataFrame([(1, " Peru ", 1, " america ", None), (2, None, 1, "x", None), (None, "x", 1, "x", None)],
                                "territory_id long, territory_name string, region_id long, region string, manager_id string")
    assert rows(silver.territories(raw)) == [(1, "Peru", 1, "AMERICA", None)]


def test_orders(spark):
    raw = spark.createDataFrame([
        (1, 1, "O", 5.0, AS_OF), (2, 1, "X", 5.0, AS_OF), (3, 1, "F", 5.0, None), (4, 1, "F", 5.0, date(2025, 1, 1)),
        (5, 1, "F", 0.0, AS_OF), (6, 9, "F", 5.0, AS_OF), (None, 1, "F", 5.0, AS_OF), (7, None, "P", 5.0, AS_OF)],
        "order_id long, customer_id long, status string, order_amount double, order_date date")
    for name in ("priority", "sales_clerk", "ship_priority", "notes"):
        from pyspark.sql import functions as F
        raw = raw.withColumn(name, F.lit(None).cast("string"))
    known = spark.createDataFrame([(1,), (1,)], "customer_id long")
    assert rows(silver.orders(raw, known, AS_OF), "order_id", "status") == [(1, "Open"), (2, "Unknown")]


def test_log_warns_below_the_rate(spark):
    bronze = spark.range(100)
    entry = quality.log_entry(bronze, spark.range(94), "orders").first()
    assert (entry.status, entry.records_failed, float(entry.pass_rate_pct)) == ("WARN", 6, 94.0)
    assert quality.log_entry(bronze, spark.range(95), "orders").first().status == "PASS"
    assert quality.log_entry(bronze, spark.range(1), "orders", always_pass=True).first().status == "PASS"
    assert quality.log_entry(spark.range(0), spark.range(0), "orders").first().pass_rate_pct is None


def test_empty_status_join_warns(spark):
    orders = spark.createDataFrame([(1, "Open")], "order_id long, status string")
    row = quality.status_join_validation(orders, spark.createDataFrame([], "order_id long")).first()
    assert row.status == "WARN"
