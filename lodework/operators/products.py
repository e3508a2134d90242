"""Data products and the registry that describes them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodework.functions import expressions as X
from lodework.functions.ranking import By, dense_ranked
from lodework.operators import gold, marts


@dataclass(frozen=True)
class Product:
    """A published table: owner, refresh rhythm and the ages at which it passes or warns."""

    name: str
    owner: str
    frequency: str
    age_unit: str
    pass_age: int
    warn_age: int
    comment: str


# The published products. Removing an entry retires the product.
REGISTRY = (
    Product("sales_rep_monthly_performance", "Sales Operations", "Daily", "HOUR", 24, 48,
            "Monthly KPIs for each sales rep."),
    Product("customer_revenue_forecast", "Finance", "Monthly", "DAY", 35, 50,
            "12-month revenue projections per customer with confidence range."),
    Product("customer_acquisition_cohort", "Marketing", "Weekly", "HOUR", 168, 240,
            "Customer retention and LTV by acquisition cohort month."),
    Product("product_performance_analytics", "Product", "Weekly", "HOUR", 168, 240,
            "Monthly product performance metrics with revenue ranking, return rates, and growth trends."),
)


def registered(*names: str) -> tuple[Product, ...]:
    return tuple(p for p in REGISTRY if p.name in names)


def retired(name: str, registry: tuple[Product, ...] = REGISTRY) -> tuple[Product, ...]:
    """The registry without one product; its SLA row disappears with it."""
    return tuple(p for p in registry if p.name != name)


def sales_rep_monthly_performance(fact: DataFrame, reps: DataFrame, *, calendar=None) -> DataFrame:
    """KPIs per representative and month with growth over the previous month that has sales."""
    dated = gold.in_calendar(fact, calendar).withColumn("month_start", X.month_start("date_key"))
    grouped = at_rep_month(dated)
    named = reps.select("rep_id", F.col("name").alias("rep_name"), "territory_name", "region", "quota").join(
        grouped, "rep_id")
    # A representative has one row per month, so each window group is bounded by the calendar.
    previous = Window.partitionBy("rep_id").orderBy("month_start")
    revenue, quota = F.col("revenue_generated"), F.col("quota")
    return named.withColumns(
        X.growth_over("revenue_generated", previous, "prev_month_revenue", "mom_growth_pct")
    ).select(
        *[c.alias(n) for n, c in X.month_calendar(F.col("month_start")).items()],
        "rep_id", "rep_name", "territory_name", "region", "quota", "unique_customers", "orders_closed",
        "revenue_generated",
        X.mean(revenue, F.col("_revenue_lines")).alias("avg_revenue_per_line"),
        X.ratio(revenue, quota, 4).alias("quota_attainment_ratio"),
        X.share_pct(revenue, quota, 1).alias("quota_attainment_pct"),
        "prev_month_revenue", "mom_growth_pct",
        marts.attainment_status(revenue, quota).alias("performance_status"),
    )


def at_rep_month(dated: DataFrame) -> DataFrame:
    return marts.at_customer_grain(
        dated, ["rep_id", "month_start"],
        F.sum("revenue").alias("revenue"),
        F.count("revenue").alias("revenue_lines"),
    ).groupBy("rep_id", "month_start").agg(
        F.count("customer_id").alias("unique_customers"),
        F.sum("orders").alias("orders_closed"),
        F.sum("revenue").alias("revenue_generated"),
        F.sum("revenue_lines").alias("_revenue_lines"),
    )


def top_reps_of_latest_year(performance: DataFrame, k: int = 10) -> DataFrame:
    latest = performance.select(F.max("year")).scalar()
    return performance.filter(F.col("year") == latest).orderBy(
        F.col("revenue_generated").desc(), "rep_id", "month").limit(k).select(
        "year", "month", "rep_name", "territory_name", "revenue_generated", "quota_attainment_pct",
        "performance_status")


# Forecast tiers by average monthly revenue, per method.
FORECAST_TIERS = {"monthly": ((5000, "Low"), (20000, "Medium")), "span": ((100, "Low"), (500, "Medium"))}


def customer_revenue_forecast(fact: DataFrame, dim_customers: DataFrame, *, inactive_tier: bool = True,
                              calendar=None) -> DataFrame:
    """Twelve-month projection from monthly spend with a band of one standard deviation."""
    dated = gold.in_calendar(fact, calendar).withColumn("month_start", X.month_start("date_key"))
    monthly = dated.groupBy("customer_id", "month_start").agg(F.sum("revenue").alias("spend"))
    cents = (F.col("spend") * 100).cast("decimal(18,0)")
    stats = monthly.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("months_active"),
        F.sum("spend").alias("_total"),
        F.sum(cents).alias("_cents"),
        F.sum((cents * cents).cast("decimal(28,0)")).alias("_squares"),
    ).select(
        "customer_id", "months_active",
        X.mean(F.col("_total"), F.col("months_active")).alias("avg_monthly_revenue"),
        (X.std_pop_cents(F.col("months_active"), F.col("_cents"), F.col("_squares")).cast("decimal(18,0)")
         / F.lit(100)).cast("decimal(18,2)").alias("revenue_volatility"),
    )
    mean, spread = F.col("avg_monthly_revenue"), F.col("revenue_volatility")
    tier = X.band(mean, FORECAST_TIERS["monthly"], "High", op="lt")
    if inactive_tier:
        tier = F.when(mean.isNull() | (mean == 0), "Inactive").otherwise(tier)
    named = dim_customers.select("customer_id", "name", "segment", "territory_name", "region", "lifetime_value")
    return named.join(stats, "customer_id").select(
        "customer_id", "name", "segment", "territory_name", "region", "lifetime_value", "months_active",
        "avg_monthly_revenue",
        (mean * 12).cast("decimal(24,2)").alias("projected_12month_revenue"),
        F.greatest(((mean - spread) * 12).cast("decimal(24,2)"), F.lit(0).cast("decimal(24,2)"))
        .alias("conservative_forecast"),
        ((mean + spread) * 12).cast("decimal(24,2)").alias("optimistic_forecast"),
        "revenue_volatility",
        tier.alias("forecast_tier"),
    )


def customer_revenue_forecast_by_span(dim_customers: DataFrame) -> DataFrame:
    """The contract's other method: spend over the active span, a band of five percent."""
    months = X.months_between_boundaries(F.col("first_order_date"), F.col("last_order_date")) + 1
    spent = F.when(F.col("first_order_date").isNotNull(), F.col("lifetime_value"))
    based = dim_customers.select(
        "customer_id", "name", "segment", "lifetime_value", months.alias("months_active"),
        X.mean(spent, months).alias("avg_monthly_revenue"))
    mean = F.col("avg_monthly_revenue")

    def scaled(factor: str):
        return F.round(mean * 12 * F.lit(factor).cast("decimal(3,2)"), 2).cast("decimal(24,2)")

    tier = X.band(mean, FORECAST_TIERS["span"], "High", op="lt")
    return based.select(
        "*", (mean * 12).cast("decimal(24,2)").alias("projected_12month_revenue"),
        scaled("0.95").alias("conservative_forecast"), scaled("1.05").alias("optimistic_forecast"),
        F.when(mean.isNull(), "Inactive").otherwise(tier).alias("forecast_tier"))


def top_forecasts(forecast: DataFrame, k: int = 10) -> DataFrame:
    return forecast.orderBy(F.col("projected_12month_revenue").desc(), "customer_id").limit(k).select(
        "customer_id", "name", "segment", "projected_12month_revenue", "conservative_forecast",
        "optimistic_forecast", "forecast_tier")


def _customer_months(dim_customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer and month with orders, and the customer's first month."""
    monthly = orders.withColumn("order_month", X.month_start("order_date")).groupBy(
        "customer_id", "order_month").agg(F.sum(X.money("order_amount")).alias("amount"))
    first = dim_customers.filter(F.col("first_order_date").isNotNull()).select(
        "customer_id", X.month_start("first_order_date").alias("cohort_month"))
    return monthly.join(first, "customer_id").withColumn(
        "months_since_acquisition", X.months_between_boundaries(F.col("cohort_month"), F.col("order_month")))


def customer_acquisition_cohort(dim_customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Retention and revenue per cohort month and months since acquisition.

    Rows arrive with one row per customer and month, so active customers are a plain
    count. Every customer is active in month 0, so that row holds the cohort size.
    """
    cells = _customer_months(dim_customers, orders).groupBy("cohort_month", "months_since_acquisition").agg(
        F.count(F.lit(1)).alias("active_customers"), F.sum("amount").alias("cohort_revenue"))
    whole = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("months_since_acquisition") == 0, F.col("active_customers"))).over(whole)
    return cells.withColumn("cohort_size", size).select(
        "cohort_month", "cohort_size", "months_since_acquisition", "active_customers",
        X.share_pct(F.col("active_customers"), F.col("cohort_size")).alias("retention_pct"),
        "cohort_revenue",
        X.ratio(F.col("cohort_revenue"), F.col("cohort_size"), 2).alias("ltv_per_acquiree"),
    )


def customer_acquisition_cohort_cells(dim_customers: DataFrame, orders: DataFrame) -> DataFrame:
    """The contract's other form: each cell is its own base and months count from one."""
    return _customer_months(dim_customers, orders).groupBy("cohort_month", "months_since_acquisition").agg(
        F.count(F.lit(1)).alias("cohort_size"), F.sum("amount").alias("cohort_revenue")).select(
        "cohort_month", (F.col("months_since_acquisition") + 1).alias("months_since_acquisition"), "cohort_size",
        F.col("cohort_size").alias("active_customers"),
        X.share_pct(F.col("cohort_size"), F.col("cohort_size"), 1).alias("retention_pct"), "cohort_revenue",
        X.ratio(F.col("cohort_revenue"), F.col("cohort_size"), 2).alias("ltv_per_acquiree"))


def first_cohort(cohorts: DataFrame, months: int = 12) -> DataFrame:
    earliest = cohorts.select(F.min("cohort_month")).scalar()
    return cohorts.filter(F.col("cohort_month") == earliest).orderBy("months_since_acquisition").limit(months)


def product_performance_analytics(fact: DataFrame, products: DataFrame, *, calendar=None, **options) -> DataFrame:
    """Revenue, returns, rank within the month, growth and tier per product and month."""
    dated = gold.in_calendar(fact, calendar).withColumn("month_start", X.month_start("date_key"))
    grouped = marts.first_of_orders(dated, ["product_id", "month_start"]).groupBy("product_id", "month_start").agg(
        F.sum("_order").alias("total_orders"),
        F.sum("quantity").alias("_quantity"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("unit_price").alias("_prices"),
        F.count("unit_price").alias("_priced"),
        F.count_if(F.col("return_flag") == "R").alias("returned_items"),
        F.count(F.lit(1)).alias("_lines"),
    )
    named = products.select("product_id", "product_name", "category", "manufacturer", "brand").join(
        grouped, "product_id")
    # A product has one row per month, so the lag groups are bounded by the calendar;
    # a month holds every product, so its rank is taken in intervals of the revenue.
    previous = Window.partitionBy("product_id").orderBy("month_start")
    grown = named.withColumns({
        **X.growth_over("total_revenue", previous, "prev_month_revenue", "mom_growth_pct"),
        "return_rate_pct": X.share_pct(F.col("returned_items"), F.col("_lines")),
    })
    placed = dense_ranked(grown, "revenue_rank", By("total_revenue", descending=True), ["month_start"], **options)
    now, before = F.col("total_revenue"), F.col("prev_month_revenue")
    tier = (
        F.when((F.col("revenue_rank") <= 50) & (F.col("return_rate_pct") < 5), "Star")
        .when((before > 0) & ((now - before) * 100 > before * 10), "Growth")
        .when(F.col("return_rate_pct") >= 10, "Underperforming")
        .otherwise("Stable")
    )
    return placed.select(
        *[c.alias(n) for n, c in X.month_calendar(F.col("month_start")).items()],
        "product_id", "product_name", "category", "manufacturer", "brand", "total_orders",
        F.round("_quantity", 0).cast("bigint").alias("total_units_sold"),
        "total_revenue",
        F.round(F.col("_prices") / F.col("_priced").cast("decimal(18,0)"), 2).cast("decimal(18,2)")
        .alias("avg_unit_price"),
        "returned_items", "return_rate_pct", "revenue_rank", "prev_month_revenue", "mom_growth_pct",
        tier.alias("performance_tier"),
    )


def tier_distribution(analytics: DataFrame) -> DataFrame:
    return analytics.groupBy("performance_tier").agg(
        F.count(F.lit(1)).alias("product_months"),
        F.sum("total_revenue").alias("_revenue"),
        F.sum("return_rate_pct").alias("_rates"),
    ).select(
        "performance_tier", "product_months",
        X.mean(F.col("_revenue"), F.col("product_months")).alias("avg_revenue"),
        X.mean(F.col("_rates"), F.col("product_months")).alias("avg_return_rate"),
    )


def growth_leaders(analytics: DataFrame, k: int = 10) -> DataFrame:
    return analytics.filter(F.col("mom_growth_pct").isNotNull()).orderBy(
        F.col("mom_growth_pct").desc(), "product_id", "year_month").limit(k).select(
        "year_month", "product_name", "category", "total_revenue", "prev_month_revenue", "mom_growth_pct")


def top_products(analytics: DataFrame, k: int = 10) -> DataFrame:
    """The best ranks of the newest months."""
    return analytics.orderBy(F.col("year").desc(), F.col("month").desc(), "revenue_rank", "product_id").limit(
        k).select("year", "month", "month_name", "product_id", "product_name", "category", "total_revenue",
                  "total_units_sold", "return_rate_pct", "revenue_rank", "performance_tier")
