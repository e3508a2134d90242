"""Landing tables: the raw tables renamed once to the vocabulary of all later layers.

Numbers keep the type of the source, so that later filters reach the Parquet scan; they
become decimals where they are summed. Columns the raw tables may lack become typed NULLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodework.functions import expressions as X


def customers(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").cast("bigint").alias("customer_id"),
        F.col("c_name").alias("name"),
        X.column_or_null(customer, "c_address", "string").alias("address"),
        F.col("c_nationkey").cast("bigint").alias("nation_key"),
        X.column_or_null(customer, "c_phone", "string").alias("phone"),
        F.col("c_acctbal").alias("account_balance"),
        F.col("c_mktsegment").alias("segment"),
        X.column_or_null(customer, "c_comment", "string").alias("notes"),
    )


def orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("o_orderkey").cast("bigint").alias("order_id"),
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("order_amount"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("priority"),
        X.column_or_null(raw, "o_clerk", "string").alias("sales_clerk"),
        X.column_or_null(raw, "o_shippriority", "int").alias("ship_priority"),
        X.column_or_null(raw, "o_comment", "string").alias("notes"),
    )


def _line_total(lineitem: DataFrame) -> Column:
    """Price after discount, rounded half up to cents.

    With double prices the product is formed in whole cents times whole percent, which
    rounds half cents as a decimal would.
    """
    if dict(lineitem.dtypes)["l_extendedprice"] != "double":
        return F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2)
    def whole(column: Column) -> Column:
        return F.floor(column * 100 + 0.5)

    hundredths = whole(F.col("l_extendedprice")) * (100 - whole(F.col("l_discount")))
    return F.signum(hundredths) * F.floor((F.abs(hundredths) + 50) / 100) / 100


def order_items(lineitem: DataFrame) -> DataFrame:
    quantity = F.col("l_quantity")
    return lineitem.select(
        F.col("l_orderkey").cast("bigint").alias("order_id"),
        F.col("l_partkey").cast("bigint").alias("product_id"),
        F.col("l_suppkey").cast("bigint").alias("supplier_id"),
        F.col("l_linenumber").cast("bigint").alias("line_number"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
        .alias("order_item_id"),
        quantity.alias("quantity"),
        F.when(quantity != 0, F.col("l_extendedprice") / quantity).alias("unit_price"),
        _line_total(lineitem).alias("line_total"),
        F.col("l_discount").alias("discount_rate"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.to_date("l_shipdate").alias("ship_date"),
        X.column_or_null(lineitem, "l_commitdate", "date").cast("date").alias("commit_date"),
        X.column_or_null(lineitem, "l_receiptdate", "date").cast("date").alias("receipt_date"),
        X.column_or_null(lineitem, "l_shipmode", "string").alias("ship_mode"),
    )


def products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("bigint").alias("product_id"),
        F.col("p_name").alias("product_name"),
        X.column_or_null(part, "p_mfgr", "string").alias("manufacturer"),
        F.col("p_brand").alias("brand"),
        X.last_word("p_type").alias("category"),
        F.col("p_type").alias("full_type"),
        F.col("p_size").cast("bigint").alias("product_size"),
        X.column_or_null(part, "p_container", "string").alias("container_type"),
        F.col("p_retailprice").alias("unit_price"),
        X.column_or_null(part, "p_comment", "string").alias("notes"),
    )


def sales_reps(supplier: DataFrame) -> DataFrame:
    """Suppliers act as sales representatives; the quota is a scaled account balance."""
    return supplier.select(
        F.col("s_suppkey").cast("bigint").alias("rep_id"),
        F.col("s_name").alias("name"),
        X.column_or_null(supplier, "s_address", "string").alias("address"),
        F.col("s_nationkey").cast("bigint").alias("nation_key"),
        X.column_or_null(supplier, "s_phone", "string").alias("phone"),
        F.col("s_acctbal").alias("account_balance"),
        F.round(F.abs(X.money("s_acctbal")) * 100, 2).cast("decimal(18,2)").alias("quota"),
        F.lit("Active").alias("status"),
        X.column_or_null(supplier, "s_comment", "string").alias("notes"),
    )


def territories(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        F.col("n_nationkey").cast("bigint").alias("territory_id"),
        F.col("n_name").alias("territory_name"),
        F.col("r_regionkey").cast("bigint").alias("region_id"),
        F.col("r_name").alias("region"),
        F.lit(None).cast("string").alias("manager_id"),
    )


def land(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All six landing tables from the seven raw ones."""
    return {
        "customers": customers(raw["customer"]),
        "orders": orders(raw["orders"]),
        "order_items": order_items(raw["lineitem"]),
        "products": products(raw["part"]),
        "sales_reps": sales_reps(raw["supplier"]),
        "territories": territories(raw["nation"], raw["region"]),
    }
