"""Data-quality checks in six dimensions, profiles and reconciliations.

Each check is one aggregate per table whose counters are then unpivoted to rows, so
that a table is scanned once however many rules apply to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodework.functions import expressions as X
from lodework.functions import ranking
from lodework.functions.ranking import By, first_at, side_by_side
from lodework.operators import silver


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def count_rows(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    return union_all([
        count_rows(df).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()
    ])


def failures(df: DataFrame, rules: Mapping[str, Column], value_name: str = "failed_rows") -> DataFrame:
    """Rows failing each named rule, from one scan."""
    counted = df.agg(*[F.count_if(rule).alias(f"c{i}") for i, rule in enumerate(rules.values())])
    pairs = [F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias(value_name))
             for i, name in enumerate(rules)]
    return counted.select(F.inline(F.array(*pairs)))


# --- the six dimensions over the silver tables ---------------------------------------------

def completeness(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    null = lambda *names: reduce(Column.__or__, [F.col(n).isNull() for n in names])
    return union_all([
        failures(customers, {"customers.customer_id nulls": null("customer_id")}),
        failures(orders, {"orders.customer_id/order_id/date nulls": null("order_id", "customer_id", "order_date")}),
        failures(items, {"order_items critical nulls": null("order_item_id", "order_id", "product_id")}),
    ])


def duplicated_keys(df: DataFrame, keys: Sequence[str], check_name: str) -> DataFrame:
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    return count_rows(repeated, "duplicate_keys").select(F.lit(check_name).alias("check_name"), "duplicate_keys")


def uniqueness(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    return union_all([
        duplicated_keys(customers, ["customer_id"], "customers duplicate customer_id"),
        duplicated_keys(orders, ["order_id"], "orders duplicate order_id"),
        duplicated_keys(items, ["order_item_id"], "order_items duplicate order_item_id"),
    ])


def timeliness(orders: DataFrame, as_of) -> DataFrame:
    return failures(orders, {"orders future-dated rows": F.col("order_date") > F.lit(as_of)})


def validity(orders: DataFrame, items: DataFrame) -> DataFrame:
    not_positive = (F.col("quantity") <= 0) | (F.col("unit_price") <= 0) | (F.col("line_total") <= 0)
    return union_all([
        failures(orders, {"orders non-positive amount": F.col("order_amount") <= 0}),
        failures(items, {
            "order_items non-positive qty/price/total": not_positive,
            "order_items line total math mismatch": silver.math_gap() >= 1,
        }),
    ])


def orphans(child: DataFrame, parent: DataFrame, key: str, check_name: str) -> DataFrame:
    lost = child.select(key).join(parent.select(key), key, "left_anti")
    return count_rows(lost, "failed_rows").select(F.lit(check_name).alias("check_name"), "failed_rows")


def accuracy(customers: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    return union_all([
        orphans(orders, customers, "customer_id", "orders orphan customer_id"),
        orphans(items, orders, "order_id", "order_items orphan order_id"),
        orphans(items, products, "product_id", "order_items orphan product_id"),
    ])


def consistency(customers: DataFrame, orders: DataFrame, territories: DataFrame) -> DataFrame:
    labels = [*silver.STATUS_LABELS.values(), "Unknown"]
    return union_all([
        failures(orders, {"orders invalid normalized status": ~F.col("status").isin(labels)}),
        failures(customers, {"customers segment not upper-trimmed": F.col("segment") != X.upper_trim("segment")}),
        failures(territories, {"territories region not upper-trimmed": F.col("region") != X.upper_trim("region")}),
    ])


def null_profile(landing: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs in critical landing columns with the size of each table."""
    # The profiled columns.
    critical = {
        "customers": ["customer_id"],
        "orders": ["order_id", "customer_id", "order_date"],
        "order_items": ["order_item_id", "quantity"],
        "products": ["product_id"],
    }
    parts = []
    for table, columns in critical.items():
        bad = [F.col(c).isNull() | (F.col(c) <= 0) if c == "quantity" else F.col(c).isNull() for c in columns]
        counted = landing[table].agg(
            F.count(F.lit(1)).alias("total_rows"),
            *[F.count_if(rule).alias(f"c{i}") for i, rule in enumerate(bad)])
        rows = [F.struct(F.lit(table.upper()).alias("table_name"), F.lit(c.upper()).alias("column_name"),
                         F.col(f"c{i}").alias("null_count"), F.col("total_rows").alias("total_rows"))
                for i, c in enumerate(columns)]
        parts.append(counted.select(F.inline(F.array(*rows))))
    return union_all(parts)


# --- row flow and log ------------------------------------------------------------------------

def row_flow(bronze: Mapping[str, DataFrame], silver_tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows before and after cleaning, per table."""
    before = table_counts(bronze).withColumnRenamed("row_count", "bronze_count")
    after = table_counts(silver_tables).withColumnRenamed("row_count", "silver_count")
    return before.join(after, "table_name").select(
        "table_name", "bronze_count", "silver_count",
        (F.col("bronze_count") - F.col("silver_count")).alias("rows_filtered"),
        X.share_pct(F.col("silver_count"), F.col("bronze_count")).alias("pass_rate_pct"),
    )


def flow_of_counts(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same from the row counts of a build (``table_name, row_count``, names with their layer)."""
    layer, table = F.substring_index("table_name", ".", 1), F.substring_index("table_name", ".", -1)
    side = lambda name: F.max(F.when(F.col("layer") == name, F.col("row_count"))).alias(f"{name}_count")
    return counts.select(layer.alias("layer"), table.alias("table_name"), "row_count").filter(
        F.col("table_name").isin(list(names))).groupBy("table_name").agg(side("bronze"), side("silver")).select(
        "table_name", "bronze_count", "silver_count",
        (F.col("bronze_count") - F.col("silver_count")).alias("rows_filtered"),
        X.share_pct(F.col("silver_count"), F.col("bronze_count")).alias("pass_rate_pct"))


def counts_of(counts: DataFrame, table: str) -> DataFrame:
    """All, passed and rejected rows of one table from the row counts of a build."""
    of = lambda name: F.max(F.when(F.col("table_name") == name, F.col("row_count")))
    return counts.agg(of(f"bronze.{table}").alias("total"), of(f"silver.{table}").alias("records_passed"),
                      of(f"rejected.{table}").alias("rejected"))


# What the log says about each checked table, and the pass rate below which it warns.
LOG_ENTRIES = {
    "customers": ("silver.customers", "Completeness + Uniqueness",
                  "NULL CUSTOMER_ID removed; duplicates deduped", "0.90"),
    "orders": ("silver.orders", "Completeness + Timeliness + Validity + Accuracy",
               "NULLs removed, future dates filtered, amount > 0, FK to customers checked", "0.95"),
    "order_items": ("silver.order_items", "All 6 DAMA Dimensions",
                    "NULLs, qty/price validity, math check, FK accuracy checks applied", "0.90"),
}


def log_entry(bronze: DataFrame, clean: DataFrame, table: str, rejected: DataFrame | None = None,
              *, always_pass: bool = False) -> DataFrame:
    """One data-quality log row: passed, failed, pass rate and PASS or WARN."""
    tagged = [bronze.select(F.lit("all").alias("side")), clean.select(F.lit("passed").alias("side"))]
    if rejected is not None:
        tagged.append(rejected.select(F.lit("rejected").alias("side")))
    counted = union_all(tagged).agg(
        F.count_if(F.col("side") == "all").alias("total"),
        F.count_if(F.col("side") == "passed").alias("records_passed"),
        F.count_if(F.col("side") == "rejected").alias("rejected"),
    )
    return log_row(counted, table, by_row=rejected is not None, always_pass=always_pass)


def checked_counts(checked: DataFrame) -> DataFrame:
    """All, passed and rejected lines, from one reading of the checked lines."""
    bad = F.col("rejection_reason").isNotNull()
    return checked.agg(F.count(F.lit(1)).alias("total"), F.count_if(~bad).alias("records_passed"), F.count_if(bad).alias("rejected"))


def log_row(counted: DataFrame, table: str, *, by_row: bool, always_pass: bool = False) -> DataFrame:
    """The log row of one table from its counts; failed rows are those rejected, or those that did not pass."""
    target, dimension, description, warn_below = LOG_ENTRIES[table]
    failed = F.col("rejected") if by_row else F.col("total") - F.col("records_passed")
    low = F.col("records_passed").cast("decimal(20,2)") < F.col("total") * F.lit(warn_below).cast("decimal(3,2)")
    return counted.select(
        F.lit(target).alias("target_table"),
        F.lit(dimension).alias("dq_dimension"),
        F.lit(description).alias("check_description"),
        "records_passed",
        failed.alias("records_failed"),
        X.share_pct(F.col("records_passed"), F.col("total")).cast("decimal(6,2)").alias("pass_rate_pct"),
        F.when(low & F.lit(not always_pass), "WARN").otherwise("PASS").alias("status"),
    )


def rejection_summary(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("rejected_rows"))


# --- profiles ----------------------------------------------------------------------------------

def order_span(orders: DataFrame) -> DataFrame:
    return orders.agg(F.min("order_date").alias("earliest_order"), F.max("order_date").alias("latest_order")).select(
        "earliest_order", "latest_order",
        X.years_between_boundaries(F.col("earliest_order"), F.col("latest_order")).alias("years_covered"))


def revenue_profile(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("order_id").alias("total_orders"),
        F.sum(X.money("order_amount")).alias("total_revenue"),
        F.count("order_amount").alias("_n"),
        X.money(F.min("order_amount")).alias("min_order"),
        X.money(F.max("order_amount")).alias("max_order"),
    ).withColumn("avg_order_value", X.mean(F.col("total_revenue"), F.col("_n"))).drop("_n")


def distribution(df: DataFrame, column: str, count_name: str, digits: int = 1) -> DataFrame:
    """Rows per value with their share of all rows."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name))
    # One row per value of an enumerated column is left, so the total is a small window.
    total = F.sum(count_name).over(Window.partitionBy())
    return counted.withColumn("pct", X.share_pct(F.col(count_name), total, digits))


# --- reconciliation and documented checks -------------------------------------------------------

def reconcile(items: DataFrame, fact: DataFrame) -> DataFrame:
    """Total revenue of the cleaned lines and of the fact table."""
    return union_all([
        items.agg(F.sum(X.money("line_total")).alias("total_revenue")).select(
            F.lit("Silver total revenue").alias("source"), "total_revenue"),
        fact.agg(F.sum("revenue").alias("total_revenue")).select(
            F.lit("Gold fact_orders revenue").alias("source"), "total_revenue"),
    ])


def revenue_variance(orders: DataFrame, product: DataFrame, month: int, tolerance: float = 50) -> DataFrame:
    """Gap between order amounts and a product's revenue in one calendar month."""
    left = orders.filter(F.month("order_date") == month).agg(F.sum(X.money("order_amount")).alias("amount"))
    right = product.filter(F.col("month") == month).agg(F.sum("revenue_generated").alias("amount"))
    gap = F.abs(F.coalesce(F.col("amount"), F.lit(0)) - F.coalesce(right.scalar(), F.lit(0)))
    return left.select(gap.alias("variance"), (gap <= F.lit(tolerance)).alias("within_tolerance"))


def calendar_loss(fact: DataFrame, start, end) -> DataFrame:
    """Lines and revenue that fall outside the calendar and so outside every mart."""
    lost = ~F.col("date_key").between(F.lit(start), F.lit(end))
    return fact.agg(
        F.count_if(lost).alias("lines_outside"),
        F.sum(F.when(lost, F.col("revenue")).otherwise(0)).cast("decimal(28,2)").alias("revenue_outside"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("revenue").alias("revenue"),
    )


def orders_in_month(orders: DataFrame, day) -> DataFrame:
    """Orders in the calendar month of ``day``; zero means the refresh should be skipped."""
    same = X.month_start("order_date") == F.trunc(F.lit(day), "MM")
    return orders.agg(F.count_if(same).alias("orders_in_month")).select(
        "orders_in_month", F.when(F.col("orders_in_month") > 0, "PASS").otherwise("SKIP").alias("status"))


def active_rep_drop(current: DataFrame, previous: DataFrame, max_drop_pct: int = 10) -> DataFrame:
    """Active representatives now and before; FAIL on a drop beyond the limit."""
    def active(df: DataFrame) -> DataFrame:
        return df.agg(F.count_if(F.col("status") == "Active").alias("n"))
    now, then = F.col("n"), active(previous).scalar()
    drop = X.share_pct(then - now, then)
    return active(current).select(
        now.alias("active_reps"), then.alias("previous_active_reps"), drop.alias("drop_pct"),
        F.when(drop > max_drop_pct, "FAIL").otherwise("PASS").alias("status"))


def no_shrink(new: DataFrame, old: DataFrame) -> DataFrame:
    """Row counts before and after a refresh; FAIL when rows were lost."""
    before = count_rows(old).scalar()
    return count_rows(new).select(
        F.col("row_count"), before.alias("previous_row_count"),
        F.when(F.col("row_count") < before, "FAIL").otherwise("PASS").alias("status"))


def forecast_outliers(forecast: DataFrame, *, outlier_above: int = 1_000_000, p99_limit: int = 500_000,
                      **options) -> DataFrame:
    """Positive forecasts, outliers and the exact interpolated 99th percentile.

    The two values beside the percentile are found from counts of the values: a coarse
    histogram first, then the values of the one interval. The built-in exact percentile
    would gather all values in one buffer.
    """
    value = F.col("projected_12month_revenue")
    values = forecast.filter(value.isNotNull()).select(value)
    share = F.lit("0.99").cast("decimal(3,2)")

    def neighbours(total: Column) -> Column:
        place = share * (total - 1)
        return F.array(*[F.struct(F.lit(i).alias("place"), at.cast("bigint").alias("position"))
                         for i, at in ((1, F.floor(place)), (2, F.ceil(place)))])

    found = first_at(values, [[By("projected_12month_revenue")]], [], neighbours, **options)
    limits = side_by_side(found, [], ["projected_12month_revenue"], 2)
    low, high = [F.col("_limits")[name]["projected_12month_revenue"] for name in ("l1", "l2")]
    counted = values.agg(F.count(F.lit(1)).alias("_n"), F.count_if(value > 0).alias("positive_forecasts"),
                         F.count_if(value > outlier_above).alias("outliers"))
    place = share * (F.col("_n") - 1)
    p99 = low + (high - low) * (place - F.floor(place))
    return ranking.beside(counted, limits, "_limits").select(
        "positive_forecasts", "outliers", F.round(p99, 4).cast("decimal(24,4)").alias("p99"),
    ).withColumn("status", F.when((F.col("p99") > p99_limit) | (F.col("positive_forecasts") < 100), "ALERT")
                 .otherwise("PASS"))


def status_join_validation(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Lines per order status as one job-log row: SUCCESS with the counts, WARN when empty.

    Lines are counted per order before the join, so an order with many lines moves as one row.
    """
    lines = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("lines"))
    per_status = orders.select("order_id", "status").join(lines, "order_id").groupBy("status").agg(
        F.sum("lines").alias("lines"))
    text = F.concat_ws("=", "status", F.col("lines").cast("string"))
    listed = per_status.agg(F.array_join(F.array_sort(F.collect_list(text)), ", ").alias("counts"))
    empty = F.col("counts") == ""
    return listed.select(
        F.lit("silver_status_validation").alias("job_name"),
        F.when(empty, "WARN").otherwise("SUCCESS").alias("status"),
        F.when(empty, "No rows produced by status aggregation.")
        .otherwise(F.concat(F.lit("Validation succeeded: "), "counts")).alias("message"),
    )
