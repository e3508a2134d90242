"""All tables of the model as lazy DataFrames over one source folder.

Each table is built on first use from the tables before it. After ``build.run`` the
same model can be opened over the stored layers; a stored table is read instead of
recomputed. Nothing here runs a job, except that the calendar, unless given, asks the
orders for their first and last day.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodework.functions import expressions as X
from lodework.operators import bi, bronze, features, gold, marts, products, quality, silver
from lodework.operators.features import Spine
from lodework.sources import landing, tables

AS_OF = date(2025, 1, 1)
LOADED_AT = datetime(2025, 1, 1)


class SalesModel:
    def __init__(self, spark: SparkSession, source_dir: str, *, as_of: date = AS_OF, loaded_at: datetime = LOADED_AT,
                 spine: Spine | None = None, calendar: tuple[date, date] | None = None, stored: Mapping[str, DataFrame] | None = None,
                 landing_tables: Mapping[str, DataFrame] | None = None, ranking: Mapping | None = None):
        self.spark, self.source_dir = spark, source_dir
        self.as_of, self.loaded_at, self._spine, self.calendar = as_of, loaded_at, spine, calendar
        self.stored = dict(stored or {})
        self.ranking = dict(ranking or {})
        self._landing_tables = landing_tables

    @cached_property
    def days(self) -> tuple[date, date]:
        """First and last day of the date dimension: those given, or such that no order lies outside."""
        return self.calendar or gold.calendar_of(self.landing["orders"], self.as_of)

    @cached_property
    def spine(self) -> Spine:
        """Observation dates of the features: every day of the date dimension unless given."""
        return self._spine or Spine(*self.days)

    def _table(self, name: str, make) -> DataFrame:
        return self.stored[name] if name in self.stored else make()

    # --- landing and bronze
    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return tables.load_all(self.spark, self.source_dir)

    @cached_property
    def landing(self) -> dict[str, DataFrame]:
        return dict(self._landing_tables) if self._landing_tables else landing.land(self.raw)

    @cached_property
    def bronze(self) -> dict[str, DataFrame]:
        """Stamped copies; row numbers are only added where they are asked for."""
        return {name: self._table(f"bronze.{name}", lambda n=name, d=df: bronze.stamp(d, n, self.loaded_at))
                for name, df in self.landing.items()}

    # --- silver
    @cached_property
    def customers(self) -> DataFrame:
        return self._table("silver.customers", lambda: silver.customers(self.bronze["customers"]))

    @cached_property
    def territories(self) -> DataFrame:
        return self._table("silver.territories", lambda: silver.territories(self.bronze["territories"]))

    @cached_property
    def products(self) -> DataFrame:
        return self._table("silver.products", lambda: silver.products(self.bronze["products"]))

    @cached_property
    def sales_reps(self) -> DataFrame:
        return self._table("silver.sales_reps", lambda: silver.sales_reps(self.bronze["sales_reps"]))

    @cached_property
    def customer_keys(self) -> DataFrame:
        """Customers as far as orders need them: the key and the nation."""
        if "silver.customers" in self.stored:
            return self.customers.select("customer_id", "nation_key")
        return silver.customers(self.bronze["customers"].select("customer_id", "nation_key", "_loaded_at"))

    @cached_property
    def product_keys(self) -> DataFrame:
        if "silver.products" in self.stored:
            return self.products.select("product_id")
        return silver.valid_products(self.bronze["products"]).select("product_id")

    @cached_property
    def orders(self) -> DataFrame:
        return self._table("silver.orders", lambda: silver.orders(
            self.bronze["orders"], self.customer_keys, self.as_of))

    @cached_property
    def order_items(self) -> DataFrame:
        return self._table("silver.order_items", lambda: silver.order_items(
            self.bronze["order_items"], self.orders, self.product_keys))

    @cached_property
    def checked_items(self) -> DataFrame:
        return self._table("silver.checked_items", lambda: silver.checked_items(
            self.bronze["order_items"], self.orders, self.product_keys))

    @cached_property
    def rejected_items(self) -> DataFrame:
        return silver.rejected(self.checked_items)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return {"customers": self.customers, "orders": self.orders, "order_items": self.order_items,
                "products": self.products, "sales_reps": self.sales_reps, "territories": self.territories}

    # --- gold
    @cached_property
    def dim_dates(self) -> DataFrame:
        return gold.dim_dates(self.spark, *self.days)

    @cached_property
    def dim_territories(self) -> DataFrame:
        return gold.dim_territories(self.territories)

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._table("gold.dim_products", lambda: gold.dim_products(self.products))

    @cached_property
    def dim_sales_reps(self) -> DataFrame:
        return self._table("gold.dim_sales_reps", lambda: gold.dim_sales_reps(self.sales_reps, self.territories))

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._table("gold.dim_customers", lambda: gold.dim_customers(
            self.customers, self.orders, self.territories))

    @cached_property
    def fact(self) -> DataFrame:
        """The fact table; built from valid lines and orders, see ``gold.fact_orders``."""
        return self._table("gold.fact_orders", self._fact)

    def _fact(self) -> DataFrame:
        if "silver.order_items" in self.stored:
            return gold.fact_orders(self.order_items, self.orders, self.customer_keys)
        lines = silver.valid_items(self.bronze["order_items"])
        known = lines.join(self.product_keys, "product_id", "left_semi")
        return gold.fact_orders(known, silver.valid_orders(self.bronze["orders"], self.as_of), self.customer_keys)

    # --- marts
    @cached_property
    def monthly_sales(self) -> DataFrame:
        return self._table("gold.monthly_sales_summary", lambda: marts.monthly_sales_summary(
            self.fact, self.dim_territories, calendar=self.calendar))

    @cached_property
    def customer_sets(self) -> DataFrame:
        """Customers per month, territory and category as sets, for distinct counts at any coarser grain."""
        return self._table("gold.customer_sets", lambda: bi.customer_sets(
            self.fact, self.dim_products, calendar=self.calendar))

    @cached_property
    def lifetime_value(self) -> DataFrame:
        return self._table("gold.customer_lifetime_value", lambda: marts.customer_lifetime_value(
            self.dim_customers, self.orders, **self.ranking))

    @cached_property
    def product_performance(self) -> DataFrame:
        return self._table("gold.product_performance", lambda: marts.product_performance(
            self.fact, self.dim_products, **self.ranking))

    @cached_property
    def scorecard(self) -> DataFrame:
        return self._table("gold.sales_rep_scorecard", lambda: marts.sales_rep_scorecard(
            self.fact, self.dim_sales_reps))

    @cached_property
    def segmentation(self) -> DataFrame:
        return self._table("gold.customer_segmentation", lambda: marts.customer_segmentation(
            self.fact, self.dim_customers, self.orders, **self.ranking))

    # --- data products
    @cached_property
    def rep_monthly(self) -> DataFrame:
        return self._table("gold.sales_rep_monthly_performance", lambda: products.sales_rep_monthly_performance(
            self.fact, self.dim_sales_reps, calendar=self.calendar))

    @cached_property
    def forecast(self) -> DataFrame:
        return self._table("gold.customer_revenue_forecast", lambda: products.customer_revenue_forecast(
            self.fact, self.dim_customers, calendar=self.calendar))

    @cached_property
    def cohorts(self) -> DataFrame:
        return self._table("gold.customer_acquisition_cohort", lambda: products.customer_acquisition_cohort(
            self.dim_customers, self.orders))

    @cached_property
    def product_analytics(self) -> DataFrame:
        return self._table("gold.product_performance_analytics", lambda: products.product_performance_analytics(
            self.fact, self.dim_products, calendar=self.calendar, **self.ranking))

    def published(self, refreshed_at: Mapping[str, datetime] | datetime | None = None) -> dict[str, DataFrame]:
        """The four data products with their refresh time, one for all or one per product."""
        named = {"sales_rep_monthly_performance": self.rep_monthly, "customer_revenue_forecast": self.forecast,
                 "customer_acquisition_cohort": self.cohorts, "product_performance_analytics": self.product_analytics}
        times = refreshed_at if isinstance(refreshed_at, Mapping) else {}
        default = self.loaded_at if refreshed_at is None or times else refreshed_at
        return {name: df if "_refreshed_at" in df.columns else df.withColumn(
                    "_refreshed_at", X.moment(times.get(name, default)))
                for name, df in named.items()}

    # --- features
    @cached_property
    def rfm_features(self) -> DataFrame:
        return self._table("features.customer_rfm", lambda: features.customer_rfm(
            self.fact, self.customer_keys, self.spine, **self.ranking))

    @cached_property
    def engagement_features(self) -> DataFrame:
        return self._table("features.customer_engagement", lambda: features.customer_engagement(
            self.dim_customers, self.spine))

    @cached_property
    def product_features(self) -> DataFrame:
        return self._table("features.product_performance", lambda: features.product_performance(
            self.fact, self.product_keys.distinct(), self.spine, **self.ranking))

    @cached_property
    def rep_features(self) -> DataFrame:
        return self._table("features.sales_rep_quota", lambda: features.sales_rep_quota(
            self.fact, self.dim_sales_reps, self.spine))

    @cached_property
    def training_customers(self) -> DataFrame:
        return features.training_data_customers(self.rfm_features, self.dim_customers)

    @cached_property
    def training_products(self) -> DataFrame:
        return features.training_data_products(self.product_features, self.dim_products)

    @cached_property
    def rfm_stretches(self) -> features.Stretches:
        return self.rfm_between()

    def rfm_between(self, *dates: date) -> features.Stretches:
        """RFM features as stretches, on all dates or from a first to a last."""
        return features.rfm_stretches(self.fact, self.customer_keys, self.spine, between=dates or None, **self.ranking)

    @cached_property
    def rfm_presence(self) -> features.Stretches:
        return features.rfm_presence(self.fact, self.spine)

    @cached_property
    def engagement_stretches(self) -> features.Stretches:
        return features.engagement_stretches(self.dim_customers, self.spine)

    @cached_property
    def engagement_presence(self) -> features.Stretches:
        return features.engagement_presence(self.dim_customers, self.spine)

    @cached_property
    def product_stretches(self) -> features.Stretches:
        """Product features without the rank."""
        return features.product_stretches(self.fact, self.product_keys.distinct(), self.spine)

    def products_per_month(self, *dates: date, least_revenue: int | None = None, training: bool = False) -> DataFrame:
        """Product features per product and month, on all dates or from a first to a last; of training rows or without attributes."""
        kept = self.product_stretches.between(*dates) if dates else self.product_stretches
        if least_revenue is not None:
            kept = kept.of(kept.rows.filter(F.col("cumulative_revenue") > least_revenue))
        shown = kept.of(features.training_data_products(kept.rows, self.dim_products)) if training else None
        return features.ranked_products_per_month(kept, shown, **self.ranking)

    def training_products_between(self, first: date, last: date, least_revenue: int | None = None) -> features.Stretches:
        """The products' training rows of a range of dates as stretches, or those above a revenue."""
        ranked = features.ranked_products(self.product_stretches, first, last, least_revenue, **self.ranking)
        return ranked.of(features.training_data_products(ranked.rows, self.dim_products))

    @cached_property
    def product_presence(self) -> features.Stretches:
        return features.product_presence(self.fact, self.product_keys.distinct(), self.spine)

    @cached_property
    def rep_stretches(self) -> features.Stretches:
        return features.rep_stretches(self.fact, self.dim_sales_reps, self.spine)

    @cached_property
    def rep_presence(self) -> features.Stretches:
        return features.rep_presence(self.dim_sales_reps, self.spine)

    @cached_property
    def training_stretches(self) -> features.Stretches:
        return self.training_between()

    def training_between(self, *dates: date) -> features.Stretches:
        """The customers' training rows as stretches, on all dates or from a first to a last."""
        return features.training_stretches(self.rfm_between(*dates), self.dim_customers)

    @cached_property
    def training_presence(self) -> features.Stretches:
        return features.training_presence(self.rfm_presence, self.dim_customers)

    @cached_property
    def training(self) -> dict[str, DataFrame]:
        return {"customer": self.training_customers, "product": self.training_products,
                "sales_rep": self.rep_features}

    # --- quality log
    @cached_property
    def row_counts(self) -> DataFrame | None:
        """``table_name, row_count`` of the tables that a build has counted while it wrote them; None without a build."""
        return self.stored.get("monitoring.row_counts")

    @cached_property
    def row_flow(self) -> DataFrame:
        """Rows before and after cleaning, from the counts of the build where there is one."""
        if self.row_counts is None:
            return quality.row_flow(self.bronze, self.silver)
        return quality.flow_of_counts(self.row_counts, list(self.silver))

    @cached_property
    def quality_log(self) -> DataFrame:
        if self.row_counts is None:
            entries = [
                quality.log_entry(self.bronze["customers"], self.customers, "customers"),
                quality.log_entry(self.bronze["orders"], self.orders, "orders"),
                quality.log_row(quality.checked_counts(self.checked_items), "order_items", by_row=True),
            ]
        else:
            entries = [quality.log_row(quality.counts_of(self.row_counts, t), t, by_row=t == "order_items")
                       for t in quality.LOG_ENTRIES]
        return quality.union_all(entries).withColumn("log_timestamp", X.moment(self.loaded_at))
