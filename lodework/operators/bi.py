"""The ten business questions and the month x territory x category roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodework.functions import expressions as X
from lodework.operators import gold, member_sets


def territory_month_growth(monthly: DataFrame) -> DataFrame:
    """Month-over-month revenue per territory; one window group holds one territory's months."""
    previous = Window.partitionBy("territory_name").orderBy("year", "month")
    return monthly.withColumns(
        X.growth_over("total_revenue", previous, "prev_month_revenue", "month_over_month_growth_pct")
    ).select("year", "month", "month_name", "territory_name", "total_revenue", "total_orders", "unique_customers",
             "avg_order_value", "prev_month_revenue", "month_over_month_growth_pct")


def top_customers(clv: DataFrame, k: int = 20) -> DataFrame:
    """The most valuable customers with a recommended action."""
    value, status = F.col("value_segment"), F.col("engagement_status")
    action = (
        F.when((value == "High-Value") & (status == "Dormant"), "URGENT: Re-engage VIP")
        .when((value == "High-Value") & (status == "At-Risk"), "HIGH: Nurture VIP")
        .when((value == "Medium-Value") & (status == "Dormant"), "MEDIUM: Check-in")
        .otherwise("Monitor")
    )
    return clv.orderBy(F.col("lifetime_value").desc(), "customer_id").limit(k).select(
        "customer_id", "name", "region", "segment", "lifetime_value", "lifetime_order_count", "engagement_status",
        "value_segment", "recency_days", action.alias("action_recommendation"))


def rep_scorecard(scorecard: DataFrame) -> DataFrame:
    return scorecard.filter(F.col("rep_id").isNotNull()).select(
        "rep_id", "name", "territory_name", "region", "quota", "total_revenue", "quota_attainment_pct",
        "unique_customers", "total_orders", "avg_revenue_per_line", "largest_order", "performance_status",
    ).orderBy(F.col("quota_attainment_pct").desc_nulls_first(), F.col("total_revenue").desc(), "rep_id")


def top_products(performance: DataFrame, k: int = 20) -> DataFrame:
    return performance.orderBy("revenue_rank", "product_id").limit(k).select(
        "revenue_rank", "product_id", "product_name", "category", "total_units_sold", "total_revenue",
        "total_orders", "avg_revenue_per_line", "avg_units_per_order", "product_flag")


def segment_mix(segmentation: DataFrame, clv: DataFrame) -> DataFrame:
    """Customers, averages and share per RFM segment and value segment."""
    mixed = segmentation.select("customer_id", "customer_segment", "monetary", "recency_days").join(
        clv.select("customer_id", "value_segment"), "customer_id")
    grouped = mixed.groupBy("customer_segment", "value_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("monetary").alias("_monetary"),
        F.sum("recency_days").alias("_recency"),
    )
    # At most one row per pair of labels from here on.
    total = F.sum("customer_count").over(Window.partitionBy())
    return grouped.select(
        "customer_segment", "value_segment", "customer_count",
        X.mean(F.col("_monetary"), F.col("customer_count")).alias("avg_customer_revenue"),
        X.mean(F.col("_recency"), F.col("customer_count"), 1).alias("avg_days_since_order"),
        X.share_pct(F.col("customer_count"), total, 1).alias("pct_of_total"),
    )


def quarterly_year_over_year(monthly: DataFrame) -> DataFrame:
    quarters = monthly.groupBy("year", "quarter", "territory_name").agg(
        F.sum("total_revenue").alias("current_year_revenue"))
    last_year = Window.partitionBy("territory_name", "quarter").orderBy("year")
    return quarters.withColumns(
        X.growth_over("current_year_revenue", last_year, "prior_year_revenue", "yoy_growth_pct")
    ).select(F.col("year").alias("current_year"), "quarter", "territory_name", "current_year_revenue",
             "prior_year_revenue", "yoy_growth_pct")


def cohort_trend(cohorts: DataFrame) -> DataFrame:
    return cohorts.select(
        "cohort_month", "months_since_acquisition", "cohort_size", "active_customers", "retention_pct",
        "cohort_revenue", "ltv_per_acquiree",
    ).orderBy(F.col("cohort_month").desc(), "months_since_acquisition")


def cash_flow(monthly: DataFrame, window_rows: int = 4) -> DataFrame:
    """Monthly totals with growth and a moving average over ``window_rows`` months.

    The global window runs over one row per month of the calendar.
    """
    months = monthly.groupBy("year", "month", "month_name").agg(
        F.sum("total_revenue").alias("total_monthly_revenue"),
        F.sum("total_orders").alias("total_monthly_orders"),
        F.sum("avg_order_value").alias("_values"),
        F.count("avg_order_value").alias("_n"),
    )
    in_order = Window.orderBy("year", "month")
    recent = in_order.rowsBetween(1 - window_rows, 0)
    revenue = F.col("total_monthly_revenue")
    return months.withColumns({
        **X.growth_over("total_monthly_revenue", in_order, "prev_month_revenue", "mom_growth_pct"),
        "revenue_moving_avg": X.mean(F.sum(revenue).over(recent), F.count(revenue).over(recent)),
    }).select("year", "month", "month_name", "total_monthly_revenue", "total_monthly_orders",
              X.mean(F.col("_values"), F.col("_n")).alias("avg_order_value"),
              "prev_month_revenue", "mom_growth_pct", "revenue_moving_avg")


def category_mix(performance: DataFrame) -> DataFrame:
    grouped = performance.groupBy("category").agg(
        F.count_distinct("product_id").alias("num_products"),
        F.sum("total_revenue").alias("category_revenue"),
        F.sum("total_units_sold").alias("units_sold"),
        F.sum("avg_revenue_per_line").alias("_averages"),
        F.count("avg_revenue_per_line").alias("_n"),
    )
    # One row per category of the product catalogue.
    return grouped.select(
        "category", "num_products", "category_revenue",
        X.share_pct(F.col("category_revenue"), F.sum("category_revenue").over(Window.partitionBy()), 1)
        .alias("revenue_contribution_pct"),
        "units_sold",
        X.mean(F.col("_averages"), F.col("_n")).alias("avg_revenue_per_line"),
        F.rank().over(Window.orderBy(F.col("category_revenue").desc())).alias("category_rank"),
    )


def territory_performance(monthly: DataFrame, scorecard: DataFrame) -> DataFrame:
    """Revenue, orders, coverage by representatives, share and rank per territory."""
    coverage = scorecard.groupBy("territory_name").agg(F.count_distinct("rep_id").alias("num_reps"))
    grouped = monthly.groupBy("territory_name").agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("avg_order_value").alias("_values"),
        F.count("avg_order_value").alias("_n"),
    )
    # One row per territory.
    return grouped.join(coverage, "territory_name", "left").select(
        "territory_name", "total_revenue", "total_orders",
        F.coalesce("num_reps", F.lit(0)).alias("num_reps"),
        X.mean(F.col("_values"), F.col("_n")).alias("avg_order_value"),
        X.share_pct(F.col("total_revenue"), F.sum("total_revenue").over(Window.partitionBy()), 1)
        .alias("revenue_share_pct"),
        F.rank().over(Window.orderBy(F.col("total_revenue").desc())).alias("territory_rank"),
    )


def month_territory_category(fact: DataFrame, territories: DataFrame, products: DataFrame, *,
                             calendar=None) -> DataFrame:
    """Distinct customers and revenue per month, territory and category.

    Lines are first summed per month, territory, product and customer, so the join to
    the products and the distinct count see fewer rows.
    """
    dated = gold.in_calendar(fact, calendar).withColumn("sales_month", X.month_start("date_key"))
    summed = dated.groupBy("sales_month", "territory_id", "product_id", "customer_id").agg(
        F.sum("revenue").alias("revenue"))
    return (
        summed.join(products.select("product_id", "category"), "product_id")
        .join(territories.select("territory_id", "territory_name"), "territory_id")
        .groupBy("sales_month", "territory_name", "category")
        .agg(F.count_distinct("customer_id").alias("unique_customers"), F.sum("revenue").alias("monthly_revenue"))
    )


def customer_sets(fact: DataFrame, products: DataFrame, *, calendar=None) -> DataFrame:
    """Customers and revenue per month, territory and category, with the customers kept as sets.

    The join to the products sees lines summed per month, territory, product and customer.
    """
    dated = gold.in_calendar(fact, calendar).withColumn("sales_month", X.month_start("date_key"))
    summed = dated.groupBy("sales_month", "territory_id", "product_id", "customer_id").agg(
        F.sum("revenue").alias("monthly_revenue"))
    known = summed.join(products.select("product_id", "category"), "product_id")
    return member_sets.cells(known, ["sales_month", "territory_id", "category"], "customer_id", "monthly_revenue")


def unique_customers(sets: DataFrame, *grain) -> DataFrame:
    """Distinct customers and revenue at a grain the cells determine: months, territories, categories or coarser."""
    return member_sets.count_members(sets, grain, "monthly_revenue", "unique_customers")


def month_territory_category_of_sets(sets: DataFrame, territories: DataFrame) -> DataFrame:
    """``month_territory_category`` from stored sets; territories of one name count together."""
    named = sets.join(territories.select("territory_id", "territory_name"), "territory_id")
    return unique_customers(named, "sales_month", "territory_name", "category")
