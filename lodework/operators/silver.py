"""Silver: deduplicated, standardised and validated tables, with every rejected line kept."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodework.functions import expressions as X

# Order status codes and their labels.
STATUS_LABELS = {"O": "Open", "F": "Fulfilled", "P": "Processing"}

# Rejection reasons.
NO_ITEM_ID = "NULL ORDER_ITEM_ID (Completeness)"
NO_ORDER_ID = "NULL ORDER_ID (Completeness)"
NO_PRODUCT_ID = "NULL PRODUCT_ID (Completeness)"
BAD_QUANTITY = "Invalid QUANTITY <= 0 (Validity)"
BAD_PRICE = "Invalid UNIT_PRICE <= 0 (Validity)"
BAD_TOTAL = "Invalid LINE_TOTAL <= 0 (Validity)"
BAD_MATH = "Math check failed: qty * unit_price * (1-discount) != line_total (Validity)"
NO_ORDER = "ORDER_ID not in Silver orders (Accuracy)"
NO_PRODUCT = "PRODUCT_ID not in Silver products (Accuracy)"
UNKNOWN_REASON = "Unknown rejection reason"
GENERIC_FK_REASON = "FK check failed (Accuracy)"

ITEM_COLUMNS = (
    "order_item_id", "order_id", "product_id", "supplier_id", "line_number", "quantity",
    "unit_price", "line_total", "discount_rate", "return_flag", "line_status", "ship_date",
    "commit_date", "receipt_date", "ship_mode",
)


def latest_per_key(df: DataFrame, key: str, newest: Sequence[str] = ("_loaded_at",)) -> DataFrame:
    """One row per key, the one with the greatest ``newest`` columns.

    An aggregate, not a row_number window: copies of a key are combined before the
    shuffle, so a key that holds much of the table does not end up in one task.
    """
    newest = [c for c in newest if c in df.columns]
    rest = [c for c in df.columns if c != key and c not in newest]
    picked = F.max(F.struct(*newest, *rest)) if newest else F.max(F.struct(*rest))
    return df.groupBy(key).agg(picked.alias("_latest")).select(
        key, *[F.col(f"_latest.{c}").alias(c) for c in df.columns if c != key])


def customers(bronze: DataFrame) -> DataFrame:
    """NULL keys dropped, latest row per customer, upper-case trimmed segment.

    Works on any subset of the columns, so that a caller that needs two of them does
    not carry the others through the shuffle.
    """
    kept = latest_per_key(bronze.filter(F.col("customer_id").isNotNull()), "customer_id")
    kept = kept.drop("_loaded_at", "_source_table", "_row_number")
    return kept.withColumn("segment", X.upper_trim("segment")) if "segment" in kept.columns else kept


def territories(bronze: DataFrame) -> DataFrame:
    named = bronze.filter(F.col("territory_id").isNotNull() & F.col("territory_name").isNotNull())
    return named.select(
        "territory_id", F.trim("territory_name").alias("territory_name"), "region_id",
        X.upper_trim("region").alias("region"), "manager_id",
    )


def valid_products(bronze: DataFrame) -> DataFrame:
    """The row filter alone; enough where only the set of product keys matters."""
    return bronze.filter(F.col("product_id").isNotNull() & (F.col("unit_price") > 0))


def products(bronze: DataFrame) -> DataFrame:
    kept = latest_per_key(valid_products(bronze), "product_id")
    category = F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit("UNKNOWN"))
    return kept.withColumn("category", X.upper_trim(category)).drop(
        "_loaded_at", "_source_table", "_row_number")


def sales_reps(bronze: DataFrame) -> DataFrame:
    kept = latest_per_key(bronze.filter(F.col("rep_id").isNotNull()), "rep_id")
    return kept.withColumns({
        "quota": X.at_least_zero(F.col("quota")),
        "status": F.coalesce("status", F.lit("Active")),
    }).drop("_loaded_at", "_source_table", "_row_number")


def sales_reps_with_territory(reps: DataFrame, territories: DataFrame) -> DataFrame:
    named = territories.select(F.col("territory_id").alias("nation_key"), "territory_name", "region")
    return reps.join(named, "nation_key", "left").select(*reps.columns, "territory_name", "region")


def valid_orders(bronze: DataFrame, as_of: date) -> DataFrame:
    """The row-level rules of orders; NULLs fail every comparison."""
    return bronze.filter(
        F.col("order_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & (F.col("order_date") <= F.lit(as_of))
        & (F.col("order_amount") > 0)
    ).withColumn("status", X.decode(F.col("status"), STATUS_LABELS, "Unknown")).drop(
        "_loaded_at", "_source_table", "_row_number")


def orders(bronze: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    return valid_orders(bronze, as_of).join(customers.select("customer_id"), "customer_id", "left_semi").select(
        "order_id", "customer_id", "status", "order_amount", "order_date", "priority", "sales_clerk",
        "ship_priority", "notes")


def math_gap() -> Column:
    """Distance between the stated line total and quantity x price x (1 - discount)."""
    kept = F.lit(1) - F.coalesce(F.col("discount_rate"), F.lit(0))
    return F.abs(F.col("quantity") * F.col("unit_price") * kept - F.col("line_total"))


def valid_items(bronze: DataFrame) -> DataFrame:
    """The row-level rules of order lines."""
    return bronze.filter(
        F.col("order_item_id").isNotNull()
        & F.col("order_id").isNotNull()
        & F.col("product_id").isNotNull()
        & (F.col("quantity") > 0)
        & (F.col("unit_price") > 0)
        & (F.col("line_total") > 0)
        & (math_gap() < 1)
    )


def order_items(bronze: DataFrame, orders: DataFrame, products: DataFrame | None) -> DataFrame:
    """Valid lines whose order and product exist; without ``products`` only the order is checked."""
    kept = valid_items(bronze).join(orders.select("order_id"), "order_id", "left_semi")
    if products is not None:
        kept = kept.join(products.select("product_id"), "product_id", "left_semi")
    return kept.select(*ITEM_COLUMNS)


def unique_items(items: DataFrame) -> DataFrame:
    """One row per line key; the layers above keep repeated lines unless asked otherwise."""
    return items.groupBy("order_item_id").agg(
        F.max(F.struct(*[c for c in items.columns if c != "order_item_id"])).alias("_line")
    ).select("order_item_id", "_line.*").select(*items.columns)


def checked_items(
    bronze: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    *,
    separate_fk_reasons: bool = True,
    null_product_reason: str = NO_PRODUCT_ID,
) -> DataFrame:
    """Every bronze line with its first failing rule, NULL for lines that pass.

    One pass over the lines yields both the accepted and the rejected set, so
    accepted + rejected = input holds row by row.
    """
    order_keys = orders.select("order_id").distinct().withColumn("_order_known", F.lit(True))
    product_keys = products.select("product_id").distinct().withColumn("_product_known", F.lit(True))
    flagged = bronze.join(order_keys, "order_id", "left").join(product_keys, "product_id", "left")

    def not_positive(name: str) -> Column:
        return F.col(name).isNull() | (F.col(name) <= 0)

    no_order, no_product = (NO_ORDER, NO_PRODUCT) if separate_fk_reasons else (GENERIC_FK_REASON,) * 2
    reason = (
        F.when(F.col("order_item_id").isNull(), NO_ITEM_ID)
        .when(F.col("order_id").isNull(), NO_ORDER_ID)
        .when(not_positive("quantity"), BAD_QUANTITY)
        .when(not_positive("unit_price"), BAD_PRICE)
        .when(not_positive("line_total"), BAD_TOTAL)
        .when(math_gap() >= 1, BAD_MATH)
        .when(F.col("_order_known").isNull(), no_order)
        .when(F.col("product_id").isNull(), null_product_reason)
        .when(F.col("_product_known").isNull(), no_product)
    )
    return flagged.withColumn("rejection_reason", reason).select(*ITEM_COLUMNS, "rejection_reason")


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("rejection_reason").isNull()).select(*ITEM_COLUMNS)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("rejection_reason").isNotNull()).select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total", "rejection_reason")


def rejected_by_key(checked: DataFrame) -> DataFrame:
    """The key-based reading of rejection: lines whose key is not among the accepted keys.

    A NULL line key compares as unknown and is left out, a failing copy of an accepted
    key is left out, and a NULL product has no reason of its own.
    """
    accepted_keys = accepted(checked).select("order_item_id")
    lines = rejected(checked).filter(F.col("order_item_id").isNotNull())
    return lines.join(accepted_keys, "order_item_id", "left_anti").withColumn(
        "rejection_reason",
        F.when(F.col("rejection_reason") == NO_PRODUCT_ID, UNKNOWN_REASON).otherwise(F.col("rejection_reason")),
    )
