"""One more observation day of a feature table, from the state stored the day before.

The state holds an entity's totals on its day, for customers also the steps of the month so
far, which the month's scores need. A day is advanced by its own facts and by those that
leave the window on it; both are ranges of ``date_key`` known beforehand, so the scan of a
fact table clustered by date reads their files only. The state meets these facts in one join
on the entity.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodework.functions import expressions as X
from lodework.functions import ranking
from lodework.functions.ranking import By
from lodework.operators import features
from lodework.operators.features import PRODUCT_TOTALS, RFM_TOTALS, Spine

_DAY = timedelta(days=1)


def _back(day: date, months: int) -> Column:
    return F.add_months(F.lit(day), -months)


def _of_month(day: date) -> Spine:
    return Spine(day.replace(day=1), day)


def moving(first: date, last: date, months: int = 12) -> Column:
    """The facts that enter or leave the window on some day from ``first`` to ``last``: two ranges of ``date_key``."""
    day = F.col("date_key")
    return day.between(F.lit(first), F.lit(last)) | day.between(_back(first - _DAY, months), _back(last, months))


# --- customers -----------------------------------------------------------------------------------

def rfm_state(fact: DataFrame, customers: DataFrame, day: date, months: int = 12) -> DataFrame:
    """The steps of the month of ``day`` up to it, from the whole history."""
    return features.rfm_steps(fact, customers, _of_month(day), months)


def rfm_next(state: DataFrame, fact: DataFrame, customers: DataFrame, day: date, months: int = 12) -> DataFrame:
    """The state of ``day`` from the state of the day before."""
    enters = F.col("date_key") == F.lit(day)
    # A date counts while it is not before the observation date less the months.
    leaves = (F.col("date_key") >= _back(day - _DAY, months)) & (F.col("date_key") < _back(day, months))
    moved = fact.filter(enters | leaves).groupBy("customer_id").agg(
        (F.count_distinct(F.when(enters, F.col("order_id"))) - F.count_distinct(F.when(leaves, F.col("order_id")))).alias("_orders"),
        F.sum(F.when(enters, F.col("revenue")).otherwise(-F.col("revenue"))).alias("_revenue"),
        F.max(F.when(enters, F.col("date_key"))).alias("_newest"))
    yesterday, first = F.lit(day - _DAY), F.lit(day.replace(day=1))
    held = state.filter(F.col("_until") == yesterday)
    unknown = customers.select("customer_id").distinct().join(held, "customer_id", "left_anti").select(
        "customer_id", *[F.lit(0).cast(t).alias(n) for n, t in RFM_TOTALS.items()], F.lit(None).cast("date").alias("_last"),
        first.alias("_from"), yesterday.alias("_until"))
    met = held.unionByName(unknown).join(moved, "customer_id", "left")
    zero = F.lit(0)
    now = F.struct(
        (F.col("frequency_12m") + F.coalesce("_orders", zero)).cast("bigint").alias("frequency_12m"),
        (F.col("monetary_12m") + F.coalesce("_revenue", zero)).cast(features.AMOUNT).alias("monetary_12m"),
        F.coalesce("_newest", "_last").alias("_last"), F.lit(day).alias("_from"), F.lit(day).alias("_until"))
    if day.day == 1:
        return met.select("customer_id", F.inline(F.array(now)))
    columns = ["frequency_12m", "monetary_12m", "_last", "_from"]
    lasts = F.struct(*columns, F.lit(day).alias("_until"))
    ended = F.struct(*columns, F.col("_until"))
    changed = F.col("_orders").isNotNull()
    steps = met.select("customer_id", F.inline(F.when(changed, F.array(ended, now)).otherwise(F.array(lasts))))
    return state.filter(F.col("_until") < yesterday).unionByName(steps)


def rfm_on(state: DataFrame, day: date, **options) -> DataFrame:
    """The feature rows of ``day``, scored over its month so far."""
    return features.scored_rfm(state, _of_month(day), only=day, **options)


# --- products ------------------------------------------------------------------------------------

def product_state(fact: DataFrame, products: DataFrame, day: date, months: int = 12) -> DataFrame:
    """The totals of every product on ``day``, from the whole history."""
    daily = features.product_days(fact.filter(F.col("date_key") <= F.lit(day)))
    return features.product_steps(daily, products, Spine(day, day), months).select("product_id", *PRODUCT_TOTALS)


def product_next(state: DataFrame, fact: DataFrame, products: DataFrame, day: date, months: int = 12) -> DataFrame:
    """The state of ``day`` from the state of the day before."""
    enters = F.col("date_key") == F.lit(day)
    # A date counts while it is after the observation date less the months.
    leaves = (F.col("date_key") > _back(day - _DAY, months)) & (F.col("date_key") <= _back(day, months))
    daily = features.product_days(fact.filter(enters | leaves))
    new = lambda c: F.sum(F.when(enters, F.col(c)).otherwise(0))
    turned = lambda c: F.sum(F.when(enters, F.col(c)).otherwise(-F.col(c)))
    changes = {"cumulative_revenue": new("revenue"), "revenue_12m": turned("revenue"), "cumulative_units_sold": new("units"),
               "units_sold_12m": turned("units"), "total_returned_items": new("returned"), "_items": new("items")}
    moved = daily.groupBy("product_id").agg(*[c.alias(f"_d_{n}") for n, c in changes.items()])
    all_known = products.select("product_id").distinct().join(state, "product_id", "left").join(moved, "product_id", "left")
    value = lambda n: F.coalesce(F.col(n), F.lit(0))
    return all_known.select("product_id", *[(value(n) + value(f"_d_{n}")).cast(t).alias(n) for n, t in PRODUCT_TOTALS.items()])


def products_on(state: DataFrame, day: date, **options) -> DataFrame:
    """The feature rows of ``day`` with the revenue rank among all products."""
    ranked = ranking.dense_ranked(state, "revenue_rank", By("cumulative_revenue", descending=True), **options)
    return ranked.select(
        "product_id", F.lit(day).alias("observation_date"), "cumulative_revenue", "revenue_12m", "cumulative_units_sold",
        "units_sold_12m", "total_returned_items",
        X.share_pct(F.col("total_returned_items"), F.col("_items")).alias("return_rate_pct"), "revenue_rank")
