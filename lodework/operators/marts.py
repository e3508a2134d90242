"""Gold marts: monthly sales, customer value, product and representative scorecards, RFM segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodework.functions import expressions as X
from lodework.functions import ranking
from lodework.functions.ranking import By
from lodework.operators import gold

VALUE = "decimal(38,2)"

# Attainment thresholds of a sales representative.
ATTAINMENT_BANDS = (("1.0", "Exceeds Quota"), ("0.8", "On Track"), ("0.5", "Below Target"))


def first_of_orders(fact: DataFrame, keys: Sequence[str], carried: str | None = None) -> DataFrame:
    """Lines of which one per (keys, order) has ``_order`` 1, so that distinct orders add up in any sum.

    Where ``carried`` is given, ``_once`` holds its greatest value on one line per (keys, order, customer).
    A task sorts the lines of its orders, which can spill and are at hand after the join by order;
    counting distinct orders would hold all of them in hash tables. The group holds one order's lines.
    """
    of_order = Window.partitionBy(*keys, "order_id")
    if carried is None:
        first = F.row_number().over(of_order.orderBy("order_id")) == 1
        return fact.withColumn("_order", F.when(first & F.col("order_id").isNotNull(), 1).otherwise(0))
    in_order = of_order.orderBy("customer_id", F.col(carried).desc_nulls_last())
    first = F.row_number().over(in_order) == 1
    same = F.col("customer_id").eqNullSafe(F.lag("customer_id").over(in_order))
    return fact.withColumns({"_order": F.when(first & F.col("order_id").isNotNull(), 1).otherwise(0),
                             "_once": F.when(first | ~same, F.col(carried))})


def at_customer_grain(fact: DataFrame, keys: Sequence[str], *measures: Column, carried: str | None = None) -> DataFrame:
    """Lines reduced to (keys, customer), with ``orders`` that add up, before customers are counted as rows."""
    return first_of_orders(fact, keys, carried).groupBy(*keys, "customer_id").agg(F.sum("_order").alias("orders"), *measures)


def attainment_status(revenue: Column, quota: Column) -> Column:
    """Band of revenue / quota, compared without dividing; no quota counts as at risk."""
    chain = None
    for threshold, label in ATTAINMENT_BANDS:
        met = (quota != 0) & (revenue >= quota * F.lit(threshold).cast("decimal(2,1)"))
        chain = F.when(met, label) if chain is None else chain.when(met, label)
    return chain.otherwise("At Risk")


def monthly_sales_summary(fact: DataFrame, territories: DataFrame, *, calendar=None) -> DataFrame:
    """Orders, customers, lines and revenue per month and territory.

    avg_order_value divides order totals summed over lines by distinct orders, so orders
    with several lines weigh more; avg_order_value_dedup counts each order once.
    """
    dated = gold.in_calendar(fact, calendar).withColumn("month_start", X.month_start("date_key"))
    grouped = at_customer_grain(
        dated, ["month_start", "territory_id"],
        F.count("order_item_key").alias("lines"),
        F.sum("revenue").alias("revenue"),
        F.count("revenue").alias("revenue_lines"),
        F.sum("order_total").alias("order_total"),
        F.sum("_once").alias("order_total_once"),
        F.max("order_total").alias("max_order"),
        F.min("order_total").alias("min_order"),
        carried="order_total",
    ).groupBy("month_start", "territory_id").agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("lines").alias("total_line_items"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("revenue_lines").alias("_revenue_lines"),
        F.sum("order_total").alias("_order_total"),
        F.sum("order_total_once").alias("_order_total_once"),
        F.max("max_order").alias("max_order_value"),
        F.min("min_order").alias("min_order_value"),
    )
    named = grouped.join(territories.select("territory_id", "territory_name", "region"), "territory_id")
    return named.select(
        *[c.alias(n) for n, c in X.month_calendar(F.col("month_start")).items()],
        "territory_id", "territory_name", "region", "total_orders", "unique_customers", "total_line_items",
        "total_revenue",
        X.mean(F.col("total_revenue"), F.col("_revenue_lines")).alias("avg_line_item_value"),
        X.mean(F.col("_order_total"), F.col("total_orders")).alias("avg_order_value"),
        X.mean(F.col("_order_total_once"), F.col("total_orders")).alias("avg_order_value_dedup"),
        "max_order_value", "min_order_value",
    )


# Value segments by percent rank and engagement by days since the last order.
VALUE_BANDS = ((0.75, "High-Value"), (0.50, "Medium-Value"), (0.25, "Low-Value"))
ENGAGEMENT_BANDS = ((365, "Churned"), (180, "At-Risk"), (90, "Dormant"))


def customer_lifetime_value(dim_customers: DataFrame, orders: DataFrame, **options) -> DataFrame:
    """Lifetime value with a percentile band and days since the newest order of the data set.

    A band needs no rank, only the value at its limit: a customer has at least a share as
    percent rank when the value lies above that of the last customer who has not. NULL
    values come last and so lie highest.
    """
    newest = orders.select(F.max("order_date")).scalar()
    shares, names = zip(*VALUE_BANDS)
    found = ranking.first_at(dim_customers.select("lifetime_value"), [[By("lifetime_value")]], [],
                             ranking.at_shares(*map(str, shares)), **options)
    limits = ranking.side_by_side(found, [], ["lifetime_value"], len(shares))
    value, band = F.col("lifetime_value"), None
    for i, name in enumerate(names, 1):
        limit = F.col("_limits")[f"l{i}"]
        # NULL at the limit: nothing lies above it.
        above = limit.isNotNull() & (value > limit["lifetime_value"]) | value.isNull() & limit["lifetime_value"].isNotNull()
        band = F.when(above, name) if band is None else band.when(above, name)
    recency = X.days_between(F.col("last_order_date"), newest)
    return ranking.beside(dim_customers, limits, "_limits").withColumn("recency_days", recency).select(
        "customer_id", "name", "segment", "territory_name", "region", "lifetime_value",
        "lifetime_order_count", "first_order_date", "last_order_date", "customer_tenure_days", "recency_days",
        band.otherwise("Minimal-Value").alias("value_segment"),
        X.band(F.col("recency_days"), ENGAGEMENT_BANDS, "Active", op="gt").alias("engagement_status"),
    )


def product_performance(fact: DataFrame, products: DataFrame, **options) -> DataFrame:
    """Orders, units, revenue, returns and two dense ranks per product."""
    returned = F.count_if(F.col("return_flag") == "R")
    grouped = first_of_orders(fact, ["product_id"]).groupBy("product_id").agg(
        F.sum("_order").alias("total_orders"),
        F.sum("quantity").alias("_quantity"),
        F.sum("revenue").alias("total_revenue"),
        F.count("revenue").alias("_revenue_lines"),
        returned.alias("returned_items"),
        F.count(F.lit(1)).alias("_lines"),
    )
    named = products.select("product_id", "product_name", "category", "manufacturer", "brand", "unit_price").join(
        grouped, "product_id")
    by_revenue = ranking.dense_ranked(named, "revenue_rank", By("total_revenue", descending=True), **options)
    by_both = ranking.dense_ranked(by_revenue, "volume_rank", By("_quantity", descending=True), **options)
    return by_both.select(
        "product_id", "product_name", "category", "manufacturer", "brand", "unit_price", "total_orders",
        F.round("_quantity", 0).cast("bigint").alias("total_units_sold"),
        "total_revenue",
        X.mean(F.col("total_revenue"), F.col("_revenue_lines")).alias("avg_revenue_per_line"),
        X.mean(F.col("_quantity"), F.col("total_orders")).alias("avg_units_per_order"),
        "returned_items",
        X.share_pct(F.col("returned_items"), F.col("_lines")).alias("return_rate_pct"),
        "revenue_rank", "volume_rank",
        X.band(F.col("revenue_rank"), ((20, "Top 20"), (100, "Top 100")), "Long Tail", op="le").alias("product_flag"),
    )


def sales_rep_scorecard(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Customers, orders, revenue and quota attainment per representative over all history."""
    grouped = at_customer_grain(
        fact, ["rep_id"],
        F.sum("revenue").alias("revenue"),
        F.count("revenue").alias("revenue_lines"),
        F.max("order_total").alias("max_order"),
        F.sum("quantity").alias("quantity"),
    ).groupBy("rep_id").agg(
        F.count("customer_id").alias("unique_customers"),
        F.sum("orders").alias("total_orders"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("revenue_lines").alias("_revenue_lines"),
        F.max("max_order").alias("largest_order"),
        F.sum("quantity").alias("_quantity"),
    )
    revenue, quota = F.col("total_revenue"), F.col("quota")
    return reps.select("rep_id", "name", "territory_name", "region", "quota").join(grouped, "rep_id").select(
        "rep_id", "name", "territory_name", "region", "quota", "unique_customers", "total_orders", "total_revenue",
        X.mean(revenue, F.col("_revenue_lines")).alias("avg_revenue_per_line"),
        "largest_order",
        X.ratio(revenue, quota, 4).alias("quota_attainment_ratio"),
        X.share_pct(revenue, quota, 1).alias("quota_attainment_pct"),
        F.round("_quantity", 0).cast("bigint").alias("total_units_sold"),
        attainment_status(revenue, quota).alias("performance_status"),
    )


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Six-way segment of the three scores."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "VIP")
        .when((r >= 3) & (f >= 3), "Loyal")
        .when((r >= 4) & (f <= 2), "New Customer")
        .when((r <= 2) & (m >= 4), "At-Risk High-Value")
        .when((r <= 2) & (f <= 2), "Churned")
        .otherwise("Growing")
    )


def customer_segmentation(fact: DataFrame, dim_customers: DataFrame, orders: DataFrame, *,
                          score_best: int = 1, **options) -> DataFrame:
    """Recency, frequency and monetary value with quintile scores and a segment.

    Score 1 is the best fifth on every axis; ``score_best=5`` turns the scale around. The
    customers at which the fifths begin are found from value counts (twelve rows in all);
    a score is the number of them that do not come after the customer.
    """
    newest = orders.select(F.max("order_date")).scalar()
    scored = first_of_orders(fact, ["customer_id"]).groupBy("customer_id").agg(
        F.max("date_key").alias("_last"),
        F.sum("_order").alias("frequency"),
        F.sum("revenue").alias("monetary"),
    ).withColumn("recency_days", X.days_between(F.col("_last"), newest)).drop("_last")
    # Every axis as a value whose least is best; a NULL sum counts as the best, as in a descending order.
    axes = {"r_score": F.col("recency_days"), "f_score": -F.col("frequency"),
            "m_score": F.coalesce(-F.col("monetary"), F.lit("-1e27").cast(VALUE))}
    axes = {name: value.cast(VALUE) for name, value in axes.items()}
    stacked = scored.select("customer_id", F.inline(F.array(*[
        F.struct(F.lit(name).alias("axis"), value.alias("value")) for name, value in axes.items()])))
    found = ranking.first_at(stacked, [[By("value")], [By("customer_id")]], ["axis"], ranking.fifths, **options)
    limits = ranking.side_by_side(found, [], ["value", "customer_id"], 4, "axis", list(axes))
    scored = ranking.beside(scored, limits, "_limits")
    for score, value in axes.items():
        begun = [F.col("_limits")[f"{score}{place}"] for place in range(1, 5)]
        passed = [F.when((value > b["value"]) | (value == b["value"]) & (F.col("customer_id") >= b["customer_id"]), 1)
                  .otherwise(0) for b in begun]
        scored = scored.withColumn(score, (F.lit(1) + sum(passed[1:], passed[0])).cast("int"))
    if score_best == 5:
        scored = scored.withColumns({s: 6 - F.col(s) for s in ("r_score", "f_score", "m_score")})
    named = scored.join(
        dim_customers.select("customer_id", "name", "segment", "territory_name", "region"), "customer_id")
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return named.select(
        "customer_id", "name", "segment", "territory_name", "region", "recency_days", "frequency", "monetary",
        "r_score", "f_score", "m_score", (r + f + m).alias("rfm_total_score"),
        rfm_segment(r, f, m).alias("customer_segment"),
    )
