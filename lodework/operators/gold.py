"""Gold: the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodework.functions import expressions as X

# The least calendar of the date dimension; it grows with the orders.
CALENDAR_START = date(1992, 1, 1)
CALENDAR_END = date(2000, 1, 1)
CALENDAR = (CALENDAR_START, CALENDAR_END)

FACT_COLUMNS = (
    "order_item_key", "order_id", "customer_id", "product_id", "rep_id", "territory_id", "date_key",
    "quantity", "unit_price", "discount_rate", "revenue", "order_total", "order_status", "return_flag",
    "line_status", "ship_mode",
)


def dim_dates(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_key"))
    return days.select("date_key", *[c.alias(n) for n, c in X.calendar(F.col("date_key")).items()])


def calendar_of(orders: DataFrame, as_of: date) -> tuple[date, date]:
    """Bounds that cover the fixed calendar and all orders up to ``as_of``: one row of two dates."""
    first, last = orders.filter(F.col("order_date") <= F.lit(as_of)).agg(F.min("order_date"), F.max("order_date")).first()
    return min(CALENDAR_START, first or CALENDAR_START), max(CALENDAR_END, last or CALENDAR_END)


def in_calendar(df: DataFrame, calendar: tuple[date, date] | None = None, day: str = "date_key") -> DataFrame:
    """What an inner join to the date dimension keeps: all days, as it covers the orders, or those of given bounds.

    The attributes are functions of the day, so the join is a filter that Spark can
    push towards the scan plus expressions evaluated after aggregation.
    """
    if calendar is None:
        return df
    return df.filter(F.col(day).between(F.lit(calendar[0]), F.lit(calendar[1])))


def dim_territories(territories: DataFrame) -> DataFrame:
    return territories.select("territory_id", "territory_name", "region_id", "region", "manager_id")


def dim_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "manufacturer", "brand", "category", "full_type",
                           "product_size", "container_type", "unit_price")


def dim_sales_reps(reps: DataFrame, territories: DataFrame) -> DataFrame:
    named = territories.select(F.col("territory_id").alias("nation_key"), "territory_name", "region")
    return reps.join(named, "nation_key", "left").select(
        "rep_id", "name", "nation_key", "territory_name", "region", "quota", "status")


def order_history(orders: DataFrame) -> DataFrame:
    """Per customer: distinct orders, value, first and last order date."""
    return orders.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("lifetime_order_count"),
        F.sum(X.money("order_amount")).alias("lifetime_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def dim_customers(customers: DataFrame, orders: DataFrame, territories: DataFrame) -> DataFrame:
    """Customers with their territory and order history.

    Orders are reduced to one row per customer before the join, so nothing but the
    customer key takes part in the grouping and a customer with very many orders is
    combined before the shuffle.
    """
    named = territories.select(F.col("territory_id").alias("nation_key"), "territory_name", "region")
    joined = customers.join(order_history(orders), "customer_id", "left").join(named, "nation_key", "left")
    return joined.select(
        "customer_id", "name", "address", "nation_key", "territory_name", "region", "phone",
        "account_balance", "segment",
        F.coalesce("lifetime_order_count", F.lit(0)).alias("lifetime_order_count"),
        F.coalesce("lifetime_value", F.lit(0)).cast("decimal(28,2)").alias("lifetime_value"),
        "first_order_date", "last_order_date",
        X.days_between(F.col("first_order_date"), F.col("last_order_date")).alias("customer_tenure_days"),
    )


def fact_orders(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order line.

    The inner joins already drop lines without an order and orders without a customer,
    so valid but unchecked lines and orders may be passed: the result is the same as
    with the referentially checked tables and two semi joins are saved.
    The representative is the number in the clerk name, else the supplier of the line.
    """
    keyed = orders.join(customers.select("customer_id", "nation_key"), "customer_id")
    order = keyed.select(
        "order_id", "customer_id", F.col("nation_key").alias("territory_id"),
        F.col("order_date").alias("date_key"), X.money("order_amount").alias("order_total"),
        F.col("status").alias("order_status"), X.digits_as_id("sales_clerk").alias("_clerk_id"))
    return items.join(order, "order_id").withColumns({
        "order_item_key": F.col("order_item_id"),
        "rep_id": F.coalesce("_clerk_id", "supplier_id"),
        "quantity": X.money("quantity"),
        "unit_price": F.col("unit_price").cast("decimal(18,8)"),
        "revenue": X.money("line_total"),
    }).select(*FACT_COLUMNS)


def semantic_search_path(metadata: DataFrame, index: DataFrame) -> DataFrame:
    """Metadata with the index entries whose source table mentions the entity.

    Both inputs are curated catalogue tables; the pattern join has no equality key.
    """
    entry = index.select("doc_id", "source_table", "chunk_text")
    mentions = F.expr("source_table ILIKE concat('%', entity_name, '%')")
    return metadata.join(entry, mentions, "left").select(
        "entity_name", "column_name", "business_definition", "doc_id", "chunk_text")


def quarterly_revenue(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("year", "quarter").agg(F.sum("total_revenue").alias("quarterly_revenue"))


def top_customers(clv: DataFrame, k: int = 10) -> DataFrame:
    return clv.orderBy(F.col("lifetime_value").desc(), "customer_id").limit(k).select(
        "customer_id", "name", "segment", "lifetime_value", "engagement_status", "value_segment")
