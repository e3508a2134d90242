"""Point-in-time feature store.

A feature table has one row per entity and observation date and must only see facts up
to that date. Joining every date to every earlier fact costs facts x dates. Here each
fact day becomes two changes of a running total, one on the day it enters the window
and one on the day it leaves; running sums over an entity's few changes give the value
between two changes, and only then are the observation dates generated, in place,
without moving rows. Cost follows facts + output.

The sums add distinct orders and lines over days, which is exact because an order
belongs to one date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodework.functions import expressions as X
from lodework.functions import ranking
from lodework.functions.ranking import By
from lodework.operators import day_ranks, gold, stretches
from lodework.operators.quality import union_all
from lodework.operators.stretches import Stretches, coverage, row_count

AMOUNT = "decimal(28,2)"
MONTH = "observation_month"


@dataclass(frozen=True)
class Spine:
    """Observation dates: every day, or every first of the month, of a closed range."""

    start: date = gold.CALENDAR_START
    end: date = gold.CALENDAR_END
    step: str = "day"

    def __post_init__(self):
        if self.step not in ("day", "month"):
            raise ValueError(f"unknown step: {self.step}")
        if self.step == "month" and self.start.day != 1:
            raise ValueError("a monthly spine starts on the first of a month")

    def at_or_after(self, day: Column) -> Column:
        """The first observation date not before ``day``."""
        day = F.greatest(day, F.lit(self.start))
        if self.step == "day":
            return day
        first = F.trunc(day, "MM")
        return F.when(first == day, day).otherwise(F.add_months(first, 1))

    def dates(self, first: Column, last: Column) -> Column:
        """Array of the observation dates from ``first`` (itself one) to ``last``; NULL if none."""
        step = F.make_dt_interval(days=F.lit(1)) if self.step == "day" else F.make_ym_interval(months=F.lit(1))
        return F.when(first <= last, F.sequence(first, last, step))

    def count(self, first: Column, last: Column) -> Column:
        """The number of observation dates from ``first`` (itself one) to ``last``."""
        months = X.months_between_boundaries(first, last)
        return ((F.datediff(last, first) if self.step == "day" else months) + 1).cast("bigint")

    def before(self, day: Column) -> Column:
        """The observation date preceding another one."""
        return F.date_sub(day, 1) if self.step == "day" else F.add_months(day, -1)

    def in_months(self, steps: DataFrame) -> DataFrame:
        """Steps cut at the ends of months: ``_month``, the part's ``_from`` and ``_until``, and its number of dates."""
        month = F.make_ym_interval(months=F.lit(1))
        cut = steps.select("*", F.explode(F.sequence(F.trunc("_from", "MM"), F.trunc("_until", "MM"), month)).alias("_month"))
        ends = F.last_day("_month") if self.step == "day" else F.col("_month")
        cut = cut.withColumns({"_from": F.greatest("_from", "_month"), "_until": F.least(F.col("_until"), ends)})
        return cut.withColumn("_dates", (F.datediff("_until", "_from") + 1).cast("bigint"))


def reaching(target: Column, months: int) -> Column:
    """The first day whose date ``months`` earlier is not before ``target``."""
    guess = F.add_months(target, months)
    return F.when(F.add_months(guess, -months) >= target, guess).otherwise(F.date_add(guess, 1))


def running_steps(
    daily: DataFrame,
    entities: DataFrame,
    entity: str,
    spine: Spine,
    enter: Mapping[str, Column],
    leave: Sequence[tuple[Column, dict]],
    totals: Mapping[str, str],
    latest: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Values that hold from one change to the next.

    daily: at most one row per entity and ``date_key``. A row changes the totals by ``enter`` on
    its day and by the deltas of ``leave`` on theirs; ``latest`` columns keep their greatest value.
    Returns (entity, totals, latest, _from, _until), several rows per entity, starting at
    the beginning of the spine. Changes before the spine count from its start on. The
    window group of an entity holds its changes, at most two per day with facts.

    The daily rows move once, by entity; their changes are made and summed where they are.
    """
    latest = latest or {}
    opened = entities.select(entity, F.lit(True).alias("_opens"))
    moved = daily.withColumn("_opens", F.lit(False)).unionByName(opened, allowMissingColumns=True).repartition(entity)
    known = ~F.col("_opens")

    def change(day: Column, deltas: Mapping[str, Column], carried: bool) -> Column:
        return F.struct(
            day.alias("day"),
            *[F.when(known, deltas.get(n, F.lit(0))).otherwise(0).cast(t).alias(n) for n, t in totals.items()],
            *[(F.when(known, c) if carried else F.lit(None).cast("date")).alias(n) for n, c in latest.items()])

    begun = change(F.when(known, F.col("date_key")).otherwise(F.lit(spine.start)), enter, True)
    changes = moved.select(entity, F.inline(F.array(
        begun, *[change(F.when(known, day), deltas, False) for day, deltas in leave]))).filter(F.col("day").isNotNull())
    changes = changes.withColumn("day", spine.at_or_after(F.col("day"))).filter(F.col("day") <= F.lit(spine.end))
    in_order = Window.partitionBy(entity).orderBy("day")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    # The last change of a day has them all in its sums.
    return changes.select(
        entity,
        *[F.sum(n).over(so_far).cast(t).alias(n) for n, t in totals.items()],
        *[F.max(n).over(so_far).alias(n) for n in latest],
        F.col("day").alias("_from"), F.lead("day").over(in_order).alias("_following"),
    ).filter(F.col("_following").isNull() | (F.col("_following") > F.col("_from"))).withColumn(
        "_until", F.coalesce(spine.before(F.col("_following")), F.lit(spine.end))).drop("_following")


def on_spine(steps: DataFrame, spine: Spine) -> DataFrame:
    """One row per observation date of each step; generated in place, no shuffle."""
    dates = F.explode(spine.dates(F.col("_from"), F.col("_until"))).alias("observation_date")
    return steps.select("*", dates).drop("_from", "_until")


# --- customers ------------------------------------------------------------------------------------

# The axes of the score whose value holds from one change to the next.
_STEADY = {"frequency": "frequency_12m", "monetary": "monetary_12m"}
_AXES = ("recency", *_STEADY)


def _recency_places(parts: DataFrame) -> DataFrame:
    """Per month and place the recency at which a fifth begins, and the position among the rows of that recency.

    Within a part the recency rises by one a day. Where it sets in and ends change the
    number of rows per recency, so counts over the calendar's few thousand recencies come
    from two changes per part, without its days.
    """
    month = Window.partitionBy("_month")
    changes = parts.filter(F.col("_last").isNotNull()).select("_month", F.inline(F.array(
        F.struct(F.datediff("_from", "_last").alias("value"), F.lit(1).alias("change")),
        F.struct((F.datediff("_until", "_last") + 1).alias("value"), F.lit(-1).alias("change")))))
    summed = changes.groupBy("_month", "value").agg(F.sum("change").alias("change"))
    in_order = month.orderBy("value")
    runs = summed.withColumns({"_rows": F.sum("change").over(in_order), "_next": F.lead("value").over(in_order)}).select(
        "_month", "value", "_rows", (F.col("_rows") * F.coalesce(F.col("_next") - F.col("value"), F.lit(0))).alias("_n"))
    unknown = parts.filter(F.col("_last").isNull()).groupBy("_month").agg(F.sum("_dates").alias("_n")).select(
        "_month", F.lit(None).cast("int").alias("value"), F.col("_n").alias("_rows"), "_n")
    upto = month.orderBy(F.col("value").asc_nulls_last())
    summed = runs.unionByName(unknown).withColumns({
        "_before": F.sum("_n").over(upto) - F.col("_n"), "_total": F.sum("_n").over(month)})
    placed = summed.withColumn("_place", F.explode(ranking.fifths(F.col("_total"))))
    into = F.col("_place.position") - F.col("_before")
    return placed.filter((into >= 0) & (into < F.col("_n"))).select(
        "_month", F.col("_place.place").alias("place"),
        (F.col("value") + F.floor(into / F.col("_rows"))).cast("int").alias("value"),
        F.when(F.col("value").isNull(), into).otherwise(into % F.col("_rows")).alias("rest"))


def _with_intervals(steps: DataFrame, resolution: int) -> DataFrame:
    """Steps with the intervals of their steady values and of the customer, coarse ones and finer ones."""
    by = {**{axis: By(c, descending=True) for axis, c in _STEADY.items()}, "customer": By("customer_id")}
    return steps.withColumns({f"_{name}_{kind}": b.interval(r) for name, b in by.items()
                              for kind, r in (("interval", resolution), ("finer", resolution * ranking.FINER))})


_PLACES = tuple(f"_rest{place}" for place in range(1, 5))


def _score_limits(parts: DataFrame) -> DataFrame:
    """Per month the rows at which the second to fifth fifth of each axis begin, as structs <axis>1 to <axis>4.

    The order is that of the axis, then customer and date. Twelve rows a month come out. Every
    look at the parts counts them in the intervals that the look before has found: of the
    value, finer ones, the values of these, then likewise the customers of the value. So no
    look deals more than counts, however many rows share a value or an interval.
    """
    steady = parts.select("_month", "_dates", F.inline(F.array(*[F.struct(
        F.lit(axis).alias("axis"), F.col(f"_{axis}_interval").alias("_interval"), F.col(f"_{axis}_finer").alias("_finer"),
        F.col(c).cast(AMOUNT).alias("value")) for axis, c in _STEADY.items()])))
    dates, group = F.sum("_dates").alias("_n"), ["axis", "_month"]
    near = ranking.narrowed(steady.groupBy(*group, "_interval").agg(dates), group, ["_interval"], _PLACES, ranking.fifths)
    for part, order in (("_finer", F.col("_finer")), ("value", By("value", descending=True).sort)):
        group = [*group, "_interval" if part == "_finer" else "_finer"]
        met = ranking.pick(steady, near, group, _PLACES)
        near = ranking.narrowed(met.groupBy(*group, *_PLACES, part).agg(dates), group, [order], _PLACES)
    of_recency = _recency_places(parts).groupBy("_month", F.col("value").cast(AMOUNT).alias("value")).agg(*[
        F.max(F.when(F.col("place") == place, F.col("rest"))).alias(name) for place, name in enumerate(_PLACES, 1)])
    near = near.select("axis", "_month", "value", "_finer", *_PLACES).unionByName(of_recency.select(
        F.lit("recency").alias("axis"), "_month", "value", F.lit(None).cast("int").alias("_finer"), *_PLACES))
    within = []
    for part in (["_customer_interval"], ["_customer_finer"], ["customer_id", "_from"]):
        group = ["axis", "_month", "value", "_finer", *within]
        counts = _with_value(parts, near, within).groupBy(*group, *_PLACES, *part).agg(dates)
        near = ranking.narrowed(counts, group, [F.col(c).asc_nulls_last() for c in part], _PLACES)
        within += part
    at = F.inline(F.array(*[F.struct(F.lit(place).alias("place"), F.col(name).alias("rest")) for place, name in enumerate(_PLACES, 1)]))
    found = near.select("axis", "_month", "value", "_finer", "customer_id", "_from", at).filter(F.col("rest").isNotNull())
    found = found.withColumn("day", F.date_add("_from", F.col("rest").cast("int")))
    return ranking.side_by_side(found, ["_month"], ["value", "customer_id", "day", "_finer"], 4, "axis", _AXES)


def _with_value(parts: DataFrame, near: DataFrame, within: Sequence[str]) -> DataFrame:
    """The rows of parts that have a value of ``near`` on its axis and lie in its customers ``within``, with the columns of ``near``.

    Of a known recency that is one day of a part, of any other value all its days.
    """
    asked = F.broadcast(near.withColumnsRenamed({c: f"_near{c}" for c in ("_month", *within)}))
    axis, value = F.col("axis"), F.col("value")
    known = value.between(F.datediff("_from", "_last"), F.datediff("_until", "_last"))
    has = (axis == "recency") & F.when(value.isNull(), F.col("_last").isNull()).otherwise(known)
    for name, c in _STEADY.items():
        has = has | (axis == name) & (F.col("_finer") == F.col(f"_{name}_finer")) & F.col(c).cast(AMOUNT).eqNullSafe(value)
    same = F.col("_month") == F.col("_near_month")
    for c in within:
        same = same & (F.col(c) == F.col(f"_near{c}"))
    one = (axis == "recency") & value.isNotNull()
    return parts.join(asked, same & has).withColumns({
        "_from": F.when(one, F.date_add("_last", value.cast("int"))).otherwise(F.col("_from")),
        "_dates": F.when(one, F.lit(1).cast("bigint")).otherwise(F.col("_dates"))})


def _reached(axis: str, place: int) -> Column:
    """The first day from which rows of a part do not come before the limit; NULL if none does.

    A part is one customer's; its rows follow each other by date. It may name a day outside
    the part.
    """
    at = F.col(f"{axis}{place}")
    later = F.when(F.col("customer_id") > at["customer_id"], F.col("_from")).when(
        F.col("customer_id") == at["customer_id"], X.uncompiled(at["day"]))
    if axis != "recency":
        value, finer = F.col(_STEADY[axis]), F.col(f"_{axis}_finer")
        near = F.when(value < at["value"], F.col("_from")).when(value == at["value"], later)
        return F.when(finer > at["_finer"], F.col("_from")).when(finer == at["_finer"], near)
    at_value = F.date_add("_last", at["value"].cast("int"))
    with_it = (F.col("customer_id") > at["customer_id"]) | (F.col("customer_id") == at["customer_id"]) & (at_value >= at["day"])
    known = F.when(at["value"].isNotNull(), F.when(with_it, at_value).otherwise(F.date_add(at_value, 1)))
    return F.when(F.col("_last").isNotNull(), known).otherwise(F.when(
        at["value"].isNotNull(), F.col("_from")).otherwise(later))


SEGMENTS = ("VIP", "Loyal", "At-Risk", "Inactive", "Engaged")
RFM_TOTALS = {"frequency_12m": "bigint", "monetary_12m": AMOUNT}


def rfm_steps(fact: DataFrame, customers: DataFrame, spine: Spine, months: int = 12) -> DataFrame:
    """Orders and revenue of the last ``months`` and the last order date, from one change to the next."""
    daily = fact.filter(F.col("date_key") <= F.lit(spine.end)).groupBy("customer_id", "date_key").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("revenue").alias("revenue"))
    gone = reaching(F.date_add("date_key", 1), months)
    return running_steps(
        daily, customers, "customer_id", spine,
        {"frequency_12m": F.col("orders"), "monetary_12m": F.col("revenue")},
        [(gone, {"frequency_12m": -F.col("orders"), "monetary_12m": -F.col("revenue")})],
        RFM_TOTALS, {"_last": F.col("date_key")})


def scored_stretches(steps: DataFrame, spine: Spine, between: tuple[date, date] | None = None,
                     resolution: int = ranking.RESOLUTION) -> Stretches:
    """Steps with quintile scores over the dates of each month, cut where a score changes; on all dates or some.

    A month's scores need its own dates only, so a range reads its months alone.
    """
    if between:
        whole = F.add_months(F.trunc(F.lit(between[1]), "MM"), 1)
        steps = Stretches(steps, spine).since(F.trunc(F.lit(between[0]), "MM")).rows.withColumn(
            "_until", F.least("_until", F.date_sub(whole, 1))).filter(F.col("_from") <= F.col("_until"))
    parts = spine.in_months(_with_intervals(steps, resolution))
    limits = _score_limits(parts).withColumnRenamed("_month", "_limit_month")
    known = parts.join(F.broadcast(limits), F.col("_month") == F.col("_limit_month")).filter(F.col("_last").isNotNull())
    reached = {f"_{axis}{place}": _reached(axis, place) for axis in _AXES for place in range(1, 5)}
    dated = Stretches(known.select("customer_id", "frequency_12m", "monetary_12m", "_last", "_from", "_until",
                                   *[c.alias(n) for n, c in reached.items()]), spine)
    dated = (dated.between(*between) if between else dated).cut(*reached)

    def score(axis: str) -> Column:
        passed = [F.when(F.col("_from") >= F.col(f"_{axis}{place}"), 1).otherwise(0) for place in range(1, 5)]
        return (F.lit(1) + sum(passed[1:], passed[0])).cast("int")

    observed = dated.rows.select(
        "customer_id", X.days_between(F.col("_last"), F.col("_from")).alias("recency_days"),
        "frequency_12m", "monetary_12m", *[score(axis).alias(f"{axis}_score") for axis in _AXES], "_from", "_until")
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    # The segments and the scores that make them. SEGMENTS lists them all.
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "VIP")
        .when((r >= 3) & (f >= 3), "Loyal")
        .when((r >= 4) & (f <= 2), "At-Risk")
        .when((r <= 2) & (f <= 2), "Inactive")
        .otherwise("Engaged")
    )
    return Stretches(observed.select(
        "customer_id", F.date_format("_from", "yyyy-MM").alias("valid_from"),
        "recency_days", "frequency_12m", "monetary_12m", "recency_score", "frequency_score", "monetary_score",
        (r + f + m).alias("rfm_composite_score"), segment.alias("estimated_segment"), "_from", "_until"),
        spine, ("recency_days",))


def scored_rfm(steps: DataFrame, spine: Spine, only: date | None = None, **options) -> DataFrame:
    """The rows of steps with quintile scores over the dates of each month, on all dates or ``only`` one."""
    return scored_stretches(steps, spine, (only, only) if only else None, **options).daily("customer_id")


def rfm_stretches(fact: DataFrame, customers: DataFrame, spine: Spine = Spine(), *, months: int = 12,
                  between: tuple[date, date] | None = None, **options) -> Stretches:
    """``customer_rfm`` as stretches within months, on all dates or those of a closed range."""
    return scored_stretches(rfm_steps(fact, customers, spine, months), spine, between, **options)


def rfm_presence(fact: DataFrame, spine: Spine = Spine()) -> Stretches:
    """The dates on which a customer has a row of ``customer_rfm``: from the first order on."""
    return present_since(fact, "customer_id", "date_key", spine)


def present_since(days: DataFrame, entity: str, day: str, spine: Spine) -> Stretches:
    """One stretch per entity, from its first day to the end of the spine."""
    first = days.groupBy(entity).agg(F.min(day).alias("_first")).filter(F.col("_first").isNotNull())
    begun = first.select(entity, spine.at_or_after(F.col("_first")).alias("_from"), F.lit(spine.end).alias("_until"))
    return Stretches(begun.filter(F.col("_from") <= F.col("_until")), spine)


def customer_rfm(fact: DataFrame, customers: DataFrame, spine: Spine = Spine(), *, months: int = 12, **options) -> DataFrame:
    """Recency, 12-month frequency and monetary value with quintile scores per calendar month.

    An order counts while its date is not before the observation date minus 12 months.
    Quintiles are taken over all customers and dates of a month, customers without
    history included; rows without history are dropped afterwards.

    No row of the daily table moves for its scores: the twelve rows of a month at which
    fifths begin are found from the customers' steps, cut at the ends of months, and a
    score counts the limits that lie at or before the row.
    """
    return rfm_stretches(fact, customers, spine, months=months, **options).daily("customer_id")


# Engagement by days since the last purchase.
ENGAGEMENT_BANDS = ((30, "Active"), (90, "Dormant"), (180, "At-Risk"))
ENGAGEMENT_LABELS = (*[label for _, label in ENGAGEMENT_BANDS], "Churned")


def _engagement_columns(day: Column) -> dict[str, Column]:
    since = X.days_between(F.col("last_order_date"), day)
    return {
        "days_since_last_purchase": since,
        "engagement_status": X.band(since, ENGAGEMENT_BANDS, "Churned", op="le"),
        "avg_order_value": X.ratio(F.col("lifetime_value"), F.col("lifetime_order_count"), 2),
        "lifetime_value_per_day": X.ratio(F.col("lifetime_value"), F.col("customer_tenure_days"), 4),
    }


ENGAGEMENT_COLUMNS = (
    "customer_id", "observation_date", "days_since_last_purchase", "engagement_status", "lifetime_value",
    "lifetime_order_count", "avg_order_value", "customer_tenure_days", "lifetime_value_per_day",
)


# What the texts of the customers' feature tables can be.
LABELS = {"estimated_segment": SEGMENTS, "rfm_segment": SEGMENTS, "engagement_status": ENGAGEMENT_LABELS}


def customers_per_month(s: Stretches) -> DataFrame:
    """``stretches.per_month`` of a feature table of customers."""
    return stretches.per_month(s, "customer_id", LABELS, [c for c in s.columns if c == "valid_from"])


def _engaged(known: Stretches) -> Stretches:
    """Engagement, cut where the band changes; known: lifetime columns and order dates, within months."""
    cut = known.cut(*[F.date_add("last_order_date", most + 1) for most, _ in ENGAGEMENT_BANDS])
    rows = cut.rows.withColumns(_engagement_columns(F.col("_from")))
    return Stretches(rows, known.spine, (*known.rising, "days_since_last_purchase"))


def engagement_stretches(dim_customers: DataFrame, spine: Spine = Spine()) -> Stretches:
    """``customer_engagement`` as stretches within months."""
    known = dim_customers.select(
        "customer_id", "first_order_date", "last_order_date", "lifetime_value", "lifetime_order_count",
        "customer_tenure_days", F.lit(spine.start).alias("_from"), F.lit(spine.end).alias("_until"))
    begun = Stretches(known, spine).since(F.col("first_order_date"))
    return _engaged(begun.in_months()).select(*[c for c in ENGAGEMENT_COLUMNS if c != "observation_date"])


def engagement_presence(dim_customers: DataFrame, spine: Spine = Spine()) -> Stretches:
    """The dates on which a customer has a row of ``customer_engagement``."""
    known = dim_customers.select("customer_id", "first_order_date", F.lit(spine.start).alias("_from"), F.lit(spine.end).alias("_until"))
    return Stretches(known, spine).since(F.col("first_order_date")).select("customer_id")


def customer_engagement(dim_customers: DataFrame, spine: Spine = Spine()) -> DataFrame:
    """Engagement on every observation date from the first order on.

    Lifetime values are those of the whole history; ``customer_engagement_pit`` restricts
    them to the observation date.
    """
    return engagement_stretches(dim_customers, spine).daily("customer_id")


def engagement_pit_stretches(orders: DataFrame, customers: DataFrame, spine: Spine = Spine()) -> Stretches:
    """``customer_engagement_pit`` as stretches within months."""
    daily = orders.filter(F.col("order_date") <= F.lit(spine.end)).groupBy(
        "customer_id", F.col("order_date").alias("date_key")).agg(
        F.count_distinct("order_id").alias("orders"), F.sum(X.money("order_amount")).alias("amount"))
    totals = {"lifetime_order_count": "bigint", "lifetime_value": AMOUNT}
    steps = running_steps(
        daily, customers, "customer_id", spine,
        {"lifetime_order_count": F.col("orders"), "lifetime_value": F.col("amount")}, [],
        totals, {"last_order_date": F.col("date_key")})
    first = daily.groupBy("customer_id").agg(F.min("date_key").alias("first_order_date"))
    known = steps.filter(F.col("last_order_date").isNotNull()).join(first, "customer_id").withColumn(
        "customer_tenure_days", X.days_between(F.col("first_order_date"), F.col("last_order_date")))
    return _engaged(Stretches(known, spine).in_months()).select(*[c for c in ENGAGEMENT_COLUMNS if c != "observation_date"])


def customer_engagement_pit(orders: DataFrame, customers: DataFrame, spine: Spine = Spine()) -> DataFrame:
    """Engagement from the orders known on each observation date only."""
    return engagement_pit_stretches(orders, customers, spine).daily("customer_id")


# --- products --------------------------------------------------------------------------------------

PRODUCT_TOTALS = {"cumulative_revenue": AMOUNT, "revenue_12m": AMOUNT, "cumulative_units_sold": AMOUNT,
                  "units_sold_12m": AMOUNT, "total_returned_items": "bigint", "_items": "bigint"}


def product_days(fact: DataFrame) -> DataFrame:
    """Revenue, units, lines and returned lines per product and day.

    A line key counts once, as returned if any of its rows is. It belongs to one order, so the
    rows of a key are sorted where the join by order put them, and only sums per day move.
    """
    is_returned = F.coalesce(F.col("return_flag") == "R", F.lit(False))
    of_line = Window.partitionBy("order_id", "product_id", "date_key", "order_item_key").orderBy(is_returned.desc())
    first = F.row_number().over(of_line) == 1
    marked = fact.select("order_id", "product_id", "date_key", "order_item_key", "revenue", "quantity", "return_flag").withColumns({
        "_line": first & F.col("order_item_key").isNotNull(), "_returned": first & is_returned})
    return marked.groupBy("product_id", "date_key").agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units"),
        F.count_if("_line").alias("items"), F.count_if("_returned").alias("returned"))


def product_steps(daily: DataFrame, products: DataFrame, spine: Spine, months: int = 12) -> DataFrame:
    """Totals of a product from one change to the next."""
    revenue, units = F.col("revenue"), F.col("units")
    steps = running_steps(
        daily, products, "product_id", spine,
        {"cumulative_revenue": revenue, "revenue_12m": revenue, "cumulative_units_sold": units,
         "units_sold_12m": units, "total_returned_items": F.col("returned"), "_items": F.col("items")},
        [(reaching(F.col("date_key"), months), {"revenue_12m": -revenue, "units_sold_12m": -units})], PRODUCT_TOTALS)
    return steps.withColumn("return_rate_pct", X.share_pct(F.col("total_returned_items"), F.col("_items")))


def product_stretches(fact: DataFrame, products: DataFrame, spine: Spine = Spine(), months: int = 12) -> Stretches:
    """``product_performance`` without the rank, as stretches from one change to the next."""
    daily = product_days(fact.filter(F.col("date_key") <= F.lit(spine.end)))
    return Stretches(product_steps(daily, products, spine, months).drop("_items"), spine)


def ranked_products(products: Stretches, first: date, last: date, least_revenue: int | None = None,
                    resolution: int = ranking.RESOLUTION) -> Stretches:
    """``product_performance`` on the dates of a range, as stretches; only rows above ``least_revenue`` where given.

    Ranks hold until some product's revenue changes, so products are ranked once per stretch
    between such days, which are at most those of the range. Rows at or below the least
    revenue have no part in the ranks above it.
    """
    in_order = Window.partitionBy("product_id").orderBy("_from")
    by = By("cumulative_revenue", descending=True)
    kept = products.between(first, last)
    changed = kept.rows.withColumn("_before", F.lag("cumulative_revenue").over(in_order)).filter(
        F.col("_before") != F.col("cumulative_revenue"))
    days = changed.agg(F.sort_array(F.collect_set("_from")).alias("days"))
    if least_revenue is not None:
        kept = kept.of(kept.rows.filter(F.col("cumulative_revenue") > least_revenue))
    # At most one change per date of the range.
    cut = kept.of(kept.rows.withColumn("_days", days.scalar())).cut(F.col("_days")).rows
    since = F.array_max(F.filter("_days", lambda d: d <= F.col("_from")))
    ranked = ranking.dense_ranked(cut.withColumn("_since", F.coalesce(since, F.lit(first))).drop("_days"),
                                  "revenue_rank", by, ["_since"], resolution=resolution)
    return kept.of(ranked).select(*kept.columns, "revenue_rank")


def ranked_products_per_month(products: Stretches, shown: Stretches | None = None, resolution: int = ranking.RESOLUTION) -> DataFrame:
    """``product_performance`` per product and month, ranks of every day included; no day moves.

    products: all that are ranked, without the rank. shown: the same rows with attributes, where
    those are wanted as well.
    """
    by = By("cumulative_revenue", descending=True)
    distinct = _distinct_alive(products.rows, by, products.spine, resolution)
    ranks = day_ranks.ranks_per_month(products.in_months(), "product_id", by, distinct, resolution)
    told = stretches.per_month(stretches.dealt_by_month(shown or products, "product_id"), "product_id")
    return day_ranks.with_ranks(told, ranks, "product_id", "revenue_rank", "return_rate_pct")


def product_presence(fact: DataFrame, products: DataFrame, spine: Spine = Spine()) -> Stretches:
    """The dates on which a product has a row of ``product_performance``: all, or from its first sale if not listed."""
    listed = products.select("product_id", F.lit(spine.start).alias("date_key"))
    return present_since(fact.select("product_id", "date_key").unionByName(listed), "product_id", "date_key", spine)


def _distinct_alive(steps: DataFrame, by: By, spine: Spine, resolution: int) -> DataFrame:
    """Per observation date and interval the number of distinct values that some entity has, from the steps.

    Steps of one value are first reduced to one per start, at most one per date; where they
    overlap or touch they merge, and each merged run is one change up and one down. So the
    days are only counted, and no row of the daily table moves.
    """
    value = by.name
    runs = steps.groupBy(value, "_from").agg(F.max("_until").alias("_until"))
    in_order = Window.partitionBy(value).orderBy("_from")
    so_far = F.max("_until").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    # A run's part beyond everything before it: none where an earlier step lasts as long.
    begun = spine.at_or_after(F.greatest(F.col("_from"), F.coalesce(F.date_add(so_far, 1), F.col("_from"))))
    added = runs.withColumn("_begun", begun).filter(F.col("_begun") <= F.col("_until"))
    changes = added.withColumn("_interval", by.interval(resolution)).select("_interval", F.inline(F.array(
        F.struct(F.col("_begun").alias("_from"), F.lit(1).alias("change")),
        F.struct(spine.at_or_after(F.date_add("_until", 1)).alias("_from"), F.lit(-1).alias("change")))))
    summed = changes.groupBy("_interval", "_from").agg(F.sum("change").alias("change"))
    # At most one row per interval and date.
    over = Window.partitionBy("_interval").orderBy("_from")
    alive = summed.select("_interval", "_from", F.sum("change").over(over).alias("_n"),
                          F.coalesce(spine.before(F.lead("_from").over(over)), F.lit(spine.end)).alias("_until"))
    return on_spine(alive.filter((F.col("_n") > 0) & (F.col("_from") <= F.lit(spine.end))), spine)


def product_performance(fact: DataFrame, products: DataFrame, spine: Spine = Spine(), *, months: int = 12,
                        resolution: int = ranking.RESOLUTION) -> DataFrame:
    """Cumulative and 12-month revenue and units, returns and revenue rank per product and date.

    A line counts in the 12-month window while its date is after the observation date
    minus 12 months. The products of a date are ranked in intervals of their revenue, so
    that one date is the work of many tasks.
    """
    daily = product_days(fact.filter(F.col("date_key") <= F.lit(spine.end)))
    steps = product_steps(daily, products, spine, months)
    by = By("cumulative_revenue", descending=True)
    observed = on_spine(ranking.placed(steps, by, resolution), spine)
    placed = ranking.dense_ranked(observed, "revenue_rank", by, ["observation_date"],
                                  distinct=_distinct_alive(steps, by, spine, resolution))
    return placed.select("product_id", "observation_date", "cumulative_revenue", "revenue_12m",
                         "cumulative_units_sold", "units_sold_12m", "total_returned_items", "return_rate_pct",
                         "revenue_rank")


# --- sales representatives -------------------------------------------------------------------------

def rep_stretches(fact: DataFrame, reps: DataFrame, spine: Spine = Spine()) -> Stretches:
    """``sales_rep_quota`` as stretches from one change to the next."""
    sold = fact.filter(F.col("date_key") <= F.lit(spine.end)).groupBy(
        "rep_id", "date_key", "order_id", "customer_id").agg(F.sum("revenue").alias("revenue"))
    # The group of a customer holds the customer's orders with a representative in one year.
    in_year = Window.partitionBy("rep_id", F.year("date_key"), "customer_id")
    marked = sold.withColumn("_new", F.when(F.min("date_key").over(in_year) == F.col("date_key"), F.col("customer_id")))
    daily = marked.groupBy("rep_id", "date_key").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("revenue").alias("revenue"),
        F.count_distinct("_new").alias("customers"))
    totals = {"ytd_revenue": AMOUNT, "cumulative_revenue": AMOUNT, "ytd_orders": "bigint",
              "ytd_customer_count": "bigint"}
    new_year = F.make_date(F.year("date_key") + 1, F.lit(1), F.lit(1))
    revenue, orders, customers = F.col("revenue"), F.col("orders"), F.col("customers")
    steps = running_steps(
        daily, reps, "rep_id", spine,
        {"ytd_revenue": revenue, "cumulative_revenue": revenue, "ytd_orders": orders, "ytd_customer_count": customers},
        [(new_year, {"ytd_revenue": -revenue, "ytd_orders": -orders, "ytd_customer_count": -customers})], totals)
    steps = steps.join(reps.select("rep_id", "quota"), "rep_id")
    ytd, quota = F.col("ytd_revenue"), F.col("quota")
    attained = steps.withColumns({
        "quota_attainment_ratio": X.ratio(ytd, quota, 4),
        "quota_attainment_pct": X.share_pct(ytd, quota, 1),
    })
    return Stretches(attained, spine).select(
        "rep_id", "quota", "ytd_revenue", "cumulative_revenue", "ytd_orders",
        "quota_attainment_ratio", "quota_attainment_pct", "ytd_customer_count")


def sales_rep_quota(fact: DataFrame, reps: DataFrame, spine: Spine = Spine()) -> DataFrame:
    """Year-to-date revenue, orders and customers, and quota attainment per representative and date.

    A customer counts from the first purchase in the year, so that distinct customers add up.
    """
    return rep_stretches(fact, reps, spine).daily("rep_id")


def rep_presence(reps: DataFrame, spine: Spine = Spine()) -> Stretches:
    """The dates on which a representative has a row of ``sales_rep_quota``: all."""
    return Stretches(reps.select("rep_id", F.lit(spine.start).alias("_from"), F.lit(spine.end).alias("_until")), spine)


# --- training sets ---------------------------------------------------------------------------------

def training_data_customers(rfm: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """RFM and engagement features on the same customer and date.

    Engagement is a function of the customer row and the date, so joining the customers
    equals joining the engagement table without generating it.
    """
    known = dim_customers.select(
        "customer_id", F.col("segment").alias("source_segment"), "region", "first_order_date", "last_order_date",
        "lifetime_value", "lifetime_order_count", "customer_tenure_days")
    joined = rfm.join(known, "customer_id").filter(F.col("observation_date") >= F.col("first_order_date"))
    return joined.withColumns(_engagement_columns(F.col("observation_date"))).select(
        "customer_id", "observation_date", "recency_days", "frequency_12m", "monetary_12m", "rfm_composite_score",
        F.col("estimated_segment").alias("rfm_segment"), "days_since_last_purchase", "engagement_status",
        "lifetime_value", "lifetime_order_count", "avg_order_value", "lifetime_value_per_day", "source_segment",
        "region", *[c for c in rfm.columns if c == MONTH])


def training_stretches(rfm: Stretches, dim_customers: DataFrame) -> Stretches:
    """``training_data_customers`` as stretches within months."""
    known = dim_customers.select(
        "customer_id", F.col("segment").alias("source_segment"), "region", "first_order_date", "last_order_date",
        "lifetime_value", "lifetime_order_count", "customer_tenure_days")
    joined = rfm.of(rfm.rows.join(known, "customer_id")).since(F.col("first_order_date"))
    return _engaged(joined).select(
        "customer_id", "recency_days", "frequency_12m", "monetary_12m", "rfm_composite_score",
        F.col("estimated_segment").alias("rfm_segment"), "days_since_last_purchase", "engagement_status",
        "lifetime_value", "lifetime_order_count", "avg_order_value", "lifetime_value_per_day", "source_segment", "region")


def training_presence(rfm: Stretches, dim_customers: DataFrame) -> Stretches:
    """The dates on which a customer has a row of ``training_data_customers``; rfm: those of ``customer_rfm``."""
    first = dim_customers.select("customer_id", "first_order_date")
    return rfm.of(rfm.rows.join(first, "customer_id")).since(F.col("first_order_date")).select("customer_id")


def training_data_products(performance: DataFrame, dim_products: DataFrame) -> DataFrame:
    attributes = dim_products.select("product_id", "category", "manufacturer", "unit_price")
    return performance.join(attributes, "product_id").select(*performance.columns, "category", "manufacturer",
                                                             "unit_price")


def observed_between(features: DataFrame, first: date, last: date) -> DataFrame:
    """Rows of a closed date range. Stored features carry their month, by which files are pruned."""
    kept = features.filter(F.col("observation_date").between(F.lit(first), F.lit(last)))
    if MONTH in features.columns:
        kept = kept.filter(F.col(MONTH).between(f"{first:%Y-%m}", f"{last:%Y-%m}"))
    return kept.drop(MONTH)


def as_of_date(features: DataFrame, key: str, ids: Sequence[int] | DataFrame, day: date,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Features of the given entities on one observation date; ids as a list or as a table."""
    at = observed_between(features, day, day)
    if isinstance(ids, DataFrame):
        at = at.join(ids.select(key), key, "left_semi")
    else:
        at = at.filter(F.col(key).isin(list(ids)))
    return at.select(key, *columns) if columns else at


def customer_features_as_of(training: DataFrame, ids, day: date, columns=None) -> DataFrame:
    at = as_of_date(training, "customer_id", ids, day).select(
        "customer_id", "observation_date", "recency_days", "frequency_12m", "monetary_12m", "rfm_composite_score",
        F.col("rfm_segment").alias("estimated_segment"), "days_since_last_purchase", "engagement_status",
        "lifetime_value", "avg_order_value")
    return at.select("customer_id", *columns) if columns else at


def product_features_as_of(training: DataFrame, ids, day: date, columns=None) -> DataFrame:
    return as_of_date(training, "product_id", ids, day, columns)


def sales_rep_features_as_of(quota: DataFrame, ids, day: date, columns=None) -> DataFrame:
    return as_of_date(quota, "rep_id", ids, day, columns)


def training_dataset(tables: Mapping[str, DataFrame], entity: str, first: date, last: date,
                     fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """Rows of a closed date range, optionally a sample of them.

    A row is drawn by a hash of its key, date and the seed, so the sample is the same
    however the rows are partitioned, and can be drawn again.
    """
    if entity not in tables:
        raise ValueError(f"Unknown entity_type: {entity}")
    kept = observed_between(tables[entity], first, last)
    if fraction >= 1.0:
        return kept
    named = F.concat_ws("|", F.lit(str(seed)), F.col(ENTITY_KEYS[entity]).cast("string"), F.col("observation_date").cast("string"))
    return kept.filter(F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("bigint") < int(fraction * (1 << 32)))


def customer_training_batch(training: DataFrame, first: date, last: date, created_at: datetime) -> DataFrame:
    return observed_between(training, first, last).select(
        "customer_id", "observation_date", "recency_days", "frequency_12m", "monetary_12m", "rfm_composite_score",
        F.col("rfm_segment").alias("estimated_segment"), "engagement_status", "lifetime_value", "avg_order_value",
        X.moment(created_at).alias("training_batch_created_at"))


# --- snapshots with validity intervals -------------------------------------------------------------

def snapshots_from_series(series: DataFrame, key: str, entity_type: str, features: Mapping[str, str]) -> DataFrame:
    """Validity intervals from a series: a row opens when a value changes and closes at the next change.

    features: feature id -> column. The groups hold one entity's values of one feature.
    """
    pairs = [F.struct(F.lit(f).alias("feature_id"), F.col(c).cast("string").alias("feature_value"))
             for f, c in features.items()]
    values = series.select(F.col(key).cast("string").alias("entity_key"), "observation_date",
                           F.inline(F.array(*pairs)))
    in_order = Window.partitionBy("feature_id", "entity_key").orderBy("observation_date")
    before = F.lag("feature_value").over(in_order)
    first = F.lag("observation_date").over(in_order).isNull()
    changed = values.withColumn("_opens", first | ~F.col("feature_value").eqNullSafe(before)).filter("_opens")
    return changed.select(
        "feature_id", F.lit(entity_type).alias("entity_type"), "entity_key", "feature_value",
        F.col("observation_date").alias("valid_from"),
        F.lead("observation_date").over(in_order).alias("valid_to"))


def snapshots_from_stretches(series: Stretches, key: str, entity_type: str, features: Mapping[str, str]) -> DataFrame:
    """``snapshots_from_series`` from stretches: only a stretch can open an interval. The groups hold one entity's stretches."""
    in_order = Window.partitionBy(key).orderBy("_from")
    first = F.lag("_from").over(in_order).isNull()
    told = {f: (first | ~F.col(c).eqNullSafe(F.lag(c).over(in_order))).alias(f"_opens_{i}")
            for i, (f, c) in enumerate(features.items())}
    pairs = [F.struct(F.lit(f).alias("feature_id"), F.col(c).cast("string").alias("feature_value"), F.col(f"_opens_{i}").alias("_opens"))
             for i, (f, c) in enumerate(features.items())]
    marked = series.rows.select(key, "_from", *features.values(), *told.values())
    changed = marked.select(key, F.col("_from").alias("valid_from"), F.inline(F.array(*pairs))).filter("_opens")
    of_feature = Window.partitionBy(key, "feature_id").orderBy("valid_from")
    return changed.select(
        "feature_id", F.lit(entity_type).alias("entity_type"), F.col(key).cast("string").alias("entity_key"), "feature_value",
        "valid_from", F.lead("valid_from").over(of_feature).alias("valid_to"))


def feature_as_of(snapshots: DataFrame, feature_id: str, entity_key: str, day: date) -> DataFrame:
    """The value valid on a day; the latest start wins."""
    valid = (F.col("valid_from") <= F.lit(day)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(day)))
    return snapshots.filter((F.col("feature_id") == feature_id) & (F.col("entity_key") == entity_key) & valid).agg(
        F.max_by("feature_value", "valid_from").alias("feature_value"))


def features_as_of(requests: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The batch form: requests of (feature_id, entity_key, as_of_date), unmatched ones kept with NULL.

    The distinct requested dates and the interval starts of an entity are merged into one
    timeline on which each request takes the last start before it: linear in both, without
    pairing requests with intervals. The intervals of an entity do not overlap.
    """
    keys = ["feature_id", "entity_key"]
    starts = snapshots.select(*keys, F.col("valid_from").alias("at"),
                              F.struct("feature_value", "valid_to").alias("started"))
    asked = requests.select(*keys, F.col("as_of_date").alias("at")).distinct().withColumn(
        "started", F.lit(None).cast(starts.schema["started"].dataType))
    # At most one start and one request per entity and day.
    timeline = starts.withColumn("asked", F.lit(False)).unionByName(asked.withColumn("asked", F.lit(True)))
    in_order = Window.partitionBy(*keys).orderBy("at", "asked").rowsBetween(Window.unboundedPreceding, 0)
    current = timeline.withColumn("current", F.last("started", ignorenulls=True).over(in_order)).filter("asked")
    open_ = F.col("current.valid_to").isNull() | (F.col("current.valid_to") > F.col("at"))
    values = current.select(*keys, F.col("at").alias("as_of_date"),
                            F.when(open_, F.col("current.feature_value")).alias("feature_value"))
    return requests.join(values, [*keys, "as_of_date"], "left")


# --- checks ----------------------------------------------------------------------------------------

ENTITY_KEYS = {"customer": "customer_id", "product": "product_id", "sales_rep": "rep_id"}


def validate_training_data(training: DataFrame, entity: str) -> DataFrame:
    """Rows present, date column present, no NULL keys, more than 30 days covered: one row of flags."""
    dated = "observation_date" in training.columns
    covered = F.datediff(F.max("observation_date"), F.min("observation_date")) > 30 if dated else F.lit(False)
    return training.agg(
        (F.count(F.lit(1)) > 0).alias("has_rows"),
        F.lit(dated).alias("has_observation_date"),
        (F.count_if(F.col(ENTITY_KEYS[entity]).isNull()) == 0).alias("no_nulls_in_keys"),
        F.coalesce(covered, F.lit(False)).alias("temporal_coverage"),
    )


def validate_stretches(training: Stretches, entity: str) -> DataFrame:
    """``validate_training_data`` of the table that stretches stand for."""
    latest = F.max("_until") if training.spine.step == "day" else F.trunc(F.max("_until"), "MM")
    return training.rows.agg(
        (F.count(F.lit(1)) > 0).alias("has_rows"),
        F.lit(True).alias("has_observation_date"),
        (F.count_if(F.col(ENTITY_KEYS[entity]).isNull()) == 0).alias("no_nulls_in_keys"),
        F.coalesce(F.datediff(latest, F.min("_from")) > 30, F.lit(False)).alias("temporal_coverage"),
    )


def importance_of_stretches(training: Stretches, target: str) -> DataFrame:
    """``feature_importance`` over all dates of stretches: correlations from their weighted sums.

    Sums are doubles. A column that does not vary is told by its least and greatest value.
    """
    numeric = [c for c in training.columns if isinstance(training.rows.schema[c].dataType, T.NumericType)]
    names = [c for c in numeric if c != target]
    # Told once per row, not once per sum: a decimal becomes a double at some cost.
    rows = training.rows.select(training.n.cast("double").alias("_n"), *[
        F.col(c).cast("double").alias(c) for c in numeric])
    n, steps, squares = F.col("_n"), F.col("_steps"), F.col("_squares")
    rows = rows.withColumns({"_steps": n * (n - 1) / 2, "_squares": n * (n - 1) * (2 * n - 1) / 6})
    rises = {c: F.lit(1.0 if c in training.rising else 0.0) for c in numeric}

    def both(a: str, b: str) -> Column:
        x, y = F.col(a), F.col(b)
        if a not in training.rising and b not in training.rising:
            return n * x * y
        return n * x * y + (rises[b] * x + rises[a] * y) * steps + rises[a] * rises[b] * squares

    def one(a: str) -> Column:
        return n * F.col(a) + steps if a in training.rising else n * F.col(a)

    def last(a: str) -> Column:
        return F.col(a) + n - 1 if a in training.rising and training.spine.step == "day" else F.col(a)

    pairs = []
    for c in names:
        known = F.col(c).isNotNull() & F.col(target).isNotNull()
        held = lambda column, known=known: F.when(known, column)
        pairs += [F.sum(held(n)).alias(f"{c}.n"), F.sum(held(one(c))).alias(f"{c}.x"), F.sum(held(one(target))).alias(f"{c}.y"),
                  F.sum(held(both(c, c))).alias(f"{c}.xx"), F.sum(held(both(target, target))).alias(f"{c}.yy"),
                  F.sum(held(both(c, target))).alias(f"{c}.xy"),
                  ((F.min(held(F.col(c))) < F.max(held(last(c))))
                   & (F.min(held(F.col(target))) < F.max(held(last(target))))).alias(f"{c}.varies")]
    sums = rows.agg(*pairs)

    def correlation(c: str) -> Column:
        total, x, y, xx, yy, xy = [F.col(f"`{c}.{part}`") for part in ("n", "x", "y", "xx", "yy", "xy")]
        return F.when(F.col(f"`{c}.varies`"), F.try_divide(total * xy - x * y, F.sqrt(F.greatest(
            total * xx - x * x, F.lit(0.0))) * F.sqrt(F.greatest(total * yy - y * y, F.lit(0.0)))))

    told = [F.struct(F.lit(c).alias("feature"), correlation(c).alias("correlation_with_target")) for c in names]
    return sums.select(F.inline(F.array(*told))).orderBy(F.abs("correlation_with_target").desc_nulls_last(), "feature")


def feature_importance(training: DataFrame, target: str) -> DataFrame:
    """Pearson correlation of every numeric column with the target, strongest first; one pass."""
    numeric = [f.name for f in training.schema.fields
               if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")
               and f.name != target]
    value = {c: F.col(c).cast("double") for c in [*numeric, target]}
    wide = training.agg(*[F.corr(value[c], value[target]).alias(c) for c in numeric])
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation_with_target")) for c in numeric]
    return wide.select(F.inline(F.array(*pairs))).orderBy(
        F.abs("correlation_with_target").desc_nulls_last(), "feature")


def _coverage(df: DataFrame, key: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(key).alias("unique_entities"),
        F.count_distinct("observation_date").alias("date_snapshots"),
        F.min("observation_date").alias("earliest_date"),
        F.max("observation_date").alias("latest_date"),
    ).withColumn("days_covered", F.datediff("latest_date", "earliest_date"))


def table_health(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, entities, dates and span per feature table; tables: name -> (table, key)."""
    return union_all([
        _coverage(df, key).select(F.lit(name).alias("feature_table"), "total_rows", "unique_entities",
                                  "date_snapshots", "earliest_date", "latest_date", "days_covered")
        for name, (df, key) in tables.items()])


def table_health_stored(tables: Mapping[str, tuple[DataFrame, str, DataFrame]]) -> DataFrame:
    """``table_health`` of stored tables: (table, key, bounds), rows and span from ``footers.bounds``.

    Only the entities are counted from rows, and that reads their column alone; days are
    counted from their own column.
    """
    parts = []
    for name, (df, key, limits) in tables.items():
        distinct = df.agg(F.count_distinct(key).alias("unique_entities"), F.count_distinct("observation_date").alias("date_snapshots"))
        low, high = F.col("observation_date_min"), F.col("observation_date_max")
        parts.append(limits.select(
            F.lit(name).alias("feature_table"), F.col("row_count").alias("total_rows"),
            distinct.select("unique_entities").scalar().alias("unique_entities"),
            distinct.select("date_snapshots").scalar().alias("date_snapshots"),
            low.alias("earliest_date"), high.alias("latest_date"), F.datediff(high, low).alias("days_covered")))
    return union_all(parts)


def table_health_of(tables: Mapping[str, tuple[Stretches, str]]) -> DataFrame:
    """``table_health`` of the tables that stretches stand for."""
    return union_all([
        coverage(s, key).select(F.lit(name).alias("feature_table"), "total_rows", "unique_entities",
                                "date_snapshots", "earliest_date", "latest_date", "days_covered")
        for name, (s, key) in tables.items()])


def training_availability(tables: Mapping[str, DataFrame | Stretches]) -> DataFrame:
    """Samples, entities, range and snapshots per entity type."""
    return union_all([
        (coverage if isinstance(df, Stretches) else _coverage)(df, ENTITY_KEYS[entity]).select(
            F.lit(entity).alias("entity_type"), F.col("total_rows").alias("training_samples"), "unique_entities",
            "earliest_date", "latest_date", F.col("days_covered").alias("date_range_days"),
            F.col("date_snapshots").alias("snapshot_count"),
            X.share_pct(F.col("total_rows"), F.col("total_rows"), 1).alias("pct_of_total"))
        for entity, df in tables.items()])


def _newest(table: DataFrame | Stretches) -> DataFrame:
    if isinstance(table, Stretches):
        latest = F.max("_until") if table.spine.step == "day" else F.trunc(F.max("_until"), "MM")
        return table.rows.agg(latest.alias("last_date"))
    return table.agg(F.max("observation_date").alias("last_date"))


def staleness(tables: Sequence[DataFrame | Stretches], today: date) -> DataFrame:
    """The newest observation date over several tables and its age in days."""
    newest = union_all([_newest(df) for df in tables])
    return newest.agg(F.max("last_date").alias("most_recent_data")).withColumn(
        "days_old", F.datediff(F.lit(today), "most_recent_data"))


def volume_health(training: Sequence[DataFrame | Stretches], least: int = 100_000) -> DataFrame:
    counted = union_all([row_count(df) for df in training])
    return counted.agg(F.sum("n").alias("total_training_rows")).withColumn(
        "status", F.when(F.col("total_training_rows") > least, "HEALTHY").otherwise("LOW"))


# --- labels and preparation ------------------------------------------------------------------------

def churn_label(training: DataFrame, orders: DataFrame, spine: Spine = Spine(), days: int = 30) -> DataFrame:
    """1 when the customer places no order in the ``days`` days after the observation date.

    Each order day marks the observation dates it follows within the horizon, which
    turns the forward look into an equality join.
    """
    day = F.col("order_date")
    marks = F.explode(spine.dates(spine.at_or_after(F.date_sub(day, days)),
                                  F.least(F.date_sub(day, 1), F.lit(spine.end))))
    returning = orders.select("customer_id", "order_date").distinct().select(
        "customer_id", marks.alias("observation_date")).distinct().withColumn("_returns", F.lit(True))
    return training.join(returning, ["customer_id", "observation_date"], "left").withColumn(
        f"churned_{days}_days", F.when(F.col("_returns"), 0).otherwise(1)).drop("_returns")


def churn_stretches(training: Stretches, orders: DataFrame, days: int = 30) -> Stretches:
    """``churn_label`` on stretches: cut where the days before an order begin and end.

    The dates that an order day marks begin after the order day before it, so a customer's
    marks do not overlap. A list holds one customer's order days.
    """
    in_order = Window.partitionBy("customer_id").orderBy("order_date")
    ordered = orders.filter(F.col("order_date").isNotNull()).select("customer_id", "order_date").distinct()
    begins = F.greatest(F.date_sub("order_date", days), F.lag("order_date").over(in_order))
    marks = ordered.select("customer_id", F.struct(begins.alias("first"), F.date_sub("order_date", 1).alias("last")).alias("_mark"))
    listed = marks.groupBy("customer_id").agg(F.collect_list("_mark").alias("_marks"))
    none = F.array().cast(listed.schema["_marks"].dataType)
    known = training.rows.join(listed, "customer_id", "left").withColumn("_marks", F.coalesce("_marks", none))
    borders = F.concat(F.transform("_marks", lambda m: m["first"]), F.transform("_marks", lambda m: F.date_add(m["last"], 1)))
    cut = training.of(known).cut(borders)
    returns = F.exists("_marks", lambda m: F.col("_from").between(m["first"], m["last"]))
    labelled = cut.rows.withColumn(f"churned_{days}_days", F.when(returns, 0).otherwise(1))
    return training.of(labelled).select(*training.columns, f"churned_{days}_days")


def mature_only(training: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Rows of customers whose tenure is longer than zero days."""
    mature = dim_customers.filter(F.col("customer_tenure_days") > 0).select("customer_id", "customer_tenure_days")
    return training.join(mature, "customer_id")


def existing_only(training: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Rows on or after the customer's first order."""
    first = dim_customers.select("customer_id", "first_order_date")
    return training.join(first, "customer_id").filter(F.col("observation_date") >= F.col("first_order_date"))


def existing_stretches(training: Stretches, dim_customers: DataFrame) -> Stretches:
    """``existing_only`` on stretches."""
    first = dim_customers.select("customer_id", "first_order_date")
    return training.of(training.rows.join(first, "customer_id")).since(F.col("first_order_date"))


# Defaults of missing features.
MISSING_DEFAULTS = {"recency_days": 999, "frequency_12m": 0, "monetary_12m": 0}


def fill_defaults(training: DataFrame, defaults: Mapping[str, float] = MISSING_DEFAULTS) -> DataFrame:
    return training.withColumns({
        c: F.coalesce(F.col(c), F.lit(v).cast(training.schema[c].dataType))
        for c, v in defaults.items() if c in training.columns})


def _next_of_stretches(training: Stretches, target: str) -> DataFrame:
    """Per stretch the ``_n`` dates whose next date is in it as well, and the one that the next stretch's value follows."""
    following = Window.partitionBy("product_id").orderBy("_from")
    led = training.rows.withColumns({"_next": F.lead(target).over(following), "_dates": training.n})
    parts = F.array(F.struct((F.col("_dates") - 1).alias("_n"), F.col(target).alias("_next")),
                    F.struct(F.lit(1).cast("bigint").alias("_n"), F.col("_next")))
    return led.select(*training.columns, F.inline(parts)).filter(F.col("_n") > 0)


def _covariance(n: Column, xy: Column, x: Column, y: Column) -> Column:
    """n times n times the population covariance, exact: its zero is a zero."""
    wide = "decimal(38,0)"
    return (n.cast(wide) * xy - x * y).cast("double")


def _moments(rows: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[str, str]], known: Column) -> list[Column]:
    """Sums over dates of hundredths of two-digit columns and of their products, as whole numbers."""
    whole, weight = {c: (F.col(c).cast("decimal(19,2)") * 100).cast("decimal(19,0)") for c in columns}, F.col("_n").cast("decimal(5,0)")
    total = lambda v: F.sum(F.when(known, v.cast("decimal(33,0)") * weight)).cast("decimal(38,0)")
    return [F.sum(F.when(known, F.col("_n"))).alias("_known"), *[total(whole[c]).alias(f"s_{c}") for c in columns],
            *[total(whole[a] * whole[b]).alias(f"s_{a}_{b}") for a, b in pairs]]


def trend_of_stretches(training: Stretches, feature: str = "revenue_12m", target: str = "cumulative_revenue",
                       least_rows: int = 10) -> DataFrame:
    """``product_trend`` from stretches, by exact sums of two-digit columns."""
    rows = _next_of_stretches(training, target).select("product_id", "_n", F.col(feature).alias("_x"), F.col("_next").alias("_y"))
    known = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    sums = rows.groupBy("product_id").agg(F.sum("_n").alias("n_rows"), *_moments(
        rows, ["_x", "_y"], [("_x", "_x"), ("_x", "_y"), ("_y", "_y")], known))
    n, x, y = F.col("_known"), F.col("s__x"), F.col("s__y")
    varies = sums.withColumns({"_xx": _covariance(n, F.col("s__x__x"), x, x), "_xy": _covariance(n, F.col("s__x__y"), x, y),
                               "_yy": _covariance(n, F.col("s__y__y"), y, y)})
    xx, xy, yy = F.col("_xx"), F.col("_xy"), F.col("_yy")
    slope = F.when(xx != 0, xy / xx)
    hundredths = lambda v: v.cast("double") / 100 / n
    r2 = F.when((xx != 0) & (yy == 0), 1.0).when(xx != 0, xy / xx * xy / yy)
    return varies.select("product_id", "n_rows", slope.alias("slope"),
                         (hundredths(y) - slope * hundredths(x)).alias("intercept"), r2.alias("r2")).filter(F.col("n_rows") >= least_rows)


def trend_fit_of_stretches(training: Stretches, features: Sequence[str] = ("revenue_12m", "units_sold_12m", "return_rate_pct"),
                           target: str = "cumulative_revenue", least_rows: int = 10) -> DataFrame:
    """``product_trend_fit`` from stretches, by exact sums of two-digit columns."""
    names = [f"_x{i}" for i in range(len(features))]
    columns = [F.coalesce(F.col(c), F.lit(0)).cast("decimal(19,2)").alias(n) for n, c in zip(names, features)]
    rows = _next_of_stretches(training, target).select("product_id", "_n", *columns, F.col("_next").alias("_y"))
    pairs = _pairs(names)
    sums = rows.groupBy("product_id").agg(F.sum("_n").alias("n_rows"), *_moments(
        rows, [*names, "_y"], pairs, F.col("_y").isNotNull()))
    n = F.col("_known")
    made = [(_covariance(n, F.col(f"s_{a}_{b}"), F.col(f"s_{a}"), F.col(f"s_{b}")) / (n * n) / 10_000).alias(f"{a}{b}") for a, b in pairs]
    return _explained(sums.select("product_id", "n_rows", *made), names, least_rows)


def _next_period(training: DataFrame, target: str) -> DataFrame:
    following = Window.partitionBy("product_id").orderBy("observation_date")
    return training.withColumn("_next", F.lead(target).over(following))


def product_trend(training: DataFrame, feature: str = "revenue_12m", target: str = "cumulative_revenue",
                  least_rows: int = 10) -> DataFrame:
    """Per product a line from one feature to the next period's target."""
    y, x = F.col("_next").cast("double"), F.col(feature).cast("double")
    return _next_period(training, target).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    ).filter(F.col("n_rows") >= least_rows)


def product_trend_fit(training: DataFrame, features: Sequence[str] = ("revenue_12m", "units_sold_12m",
                                                                      "return_rate_pct"),
                      target: str = "cumulative_revenue", least_rows: int = 10) -> DataFrame:
    """Per product the share of variance that a line of several features explains of the next period's target.

    The covariances are built-in aggregates, so a product's rows combine before the
    shuffle; the normal equations are then eliminated feature by feature in one row.
    A feature that the ones before it determine is left out.
    """
    names = [f"_x{i}" for i in range(len(features))]
    known = F.col("_next").isNotNull()
    columns = [F.when(known, F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(n) for n, c in zip(names, features)]
    rows = _next_period(training, target).select("product_id", *columns, F.col("_next").cast("double").alias("_y"))
    sums = rows.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.covar_pop(a, b).alias(f"{a}{b}") for a, b in _pairs(names)])
    return _explained(sums, names, least_rows)


def _pairs(names: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(names) for b in [*names[i:], "_y"]] + [("_y", "_y")]


def _explained(sums: DataFrame, names: Sequence[str], least_rows: int) -> DataFrame:
    """The share of the variance of ``_y`` that the names explain, from covariances."""
    explained = F.lit(0.0)
    kept = {f"{n}{n}": f"_v{n}" for n in names}
    sums = sums.withColumns({v: F.col(c) for c, v in kept.items()}).filter(F.col("n_rows") >= least_rows)
    for i, a in enumerate(names):
        usable = F.col(f"{a}{a}") > 1e-9 * F.col(f"_v{a}")
        explained = explained + F.col(f"_e{a}")
        sums = sums.withColumn(f"_e{a}", F.when(usable, F.col(f"{a}_y") * F.col(f"{a}_y") / F.col(f"{a}{a}")).otherwise(0.0))
        rest = [(b, c) for j, b in enumerate(names[i + 1:], i + 1) for c in names[j:] + ["_y"]]
        sums = sums.withColumns({
            f"{b}{c}": F.when(usable, F.col(f"{b}{c}") - F.col(f"{a}{b}") * F.col(f"{a}{c}") / F.col(f"{a}{a}"))
            .otherwise(F.col(f"{b}{c}")) for b, c in rest})
    return sums.select("product_id", "n_rows", (explained / F.nullif(F.col("_y_y"), F.lit(0.0))).alias("r2"))


# --- kept up by deltas -------------------------------------------------------------------------------

def advance_snapshots(open_: DataFrame, added: DataFrame) -> DataFrame:
    """Open intervals carried through a later stretch of the series: those it closes, and those open after it.

    open_: the stored intervals without an end; added: the later stretch's own intervals
    (``snapshots_from_series``). An entity that keeps its value keeps its interval; others
    close it where the first new one begins. Closed intervals are never read again, and
    entities without new rows pass through a join on their key.
    """
    keys = ["feature_id", "entity_type", "entity_key"]
    listed = added.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(
        "valid_from", "feature_value", "valid_to"))).alias("_added"))
    before = open_.select(*keys, F.struct("valid_from", "feature_value", "valid_to").alias("_open"))
    both = before.join(listed, keys, "full").select(*keys, "_open", F.coalesce("_added", F.array().cast(
        listed.schema["_added"].dataType)).alias("_added"))
    first = F.get("_added", F.lit(0))
    goes_on = F.col("_open")["feature_value"].eqNullSafe(first["feature_value"]) & F.col("_open").isNotNull() & first.isNotNull()
    told = lambda start, value, end: F.struct(start.alias("valid_from"), value.alias("feature_value"), end.alias("valid_to"))
    rest = F.slice("_added", F.lit(2), F.greatest(F.size("_added") - 1, F.lit(0)))
    kept = told(F.col("_open")["valid_from"], F.col("_open")["feature_value"], first["valid_to"])
    ended = told(F.col("_open")["valid_from"], F.col("_open")["feature_value"], first["valid_from"])
    rows = (F.when(first.isNull(), F.array("_open")).when(F.col("_open").isNull(), F.col("_added"))
            .when(goes_on, F.concat(F.array(kept), rest)).otherwise(F.concat(F.array(ended), F.col("_added"))))
    return both.select(*keys, F.inline(rows)).select(
        "feature_id", "entity_type", "entity_key", "feature_value", "valid_from", "valid_to")


class SnapshotStore:
    """Validity intervals in a folder per stretch of the series: those it closed, and those open after it.

    All intervals are the closed ones of every stretch and the open ones of the newest. A
    stretch that is fed again writes its folder again. Names sort as their stretches follow.
    """

    def __init__(self, spark, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _stretch(self, name: str, is_open: int) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.folder}/stretch={name}")
        return stored.filter(F.col("is_open") == is_open).drop("is_open")

    def feed(self, added: DataFrame, name: str, after: str | None) -> None:
        """Take in the stretch ``name`` that follows the stretch ``after`` (None for the first)."""
        now = added if after is None else advance_snapshots(self._stretch(after, 1), added)
        now.withColumn("is_open", F.col("valid_to").isNull().cast("int")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("is_open").parquet(f"{self.folder}/stretch={name}")

    def read(self, newest: str) -> DataFrame:
        """All intervals after the stretch ``newest``."""
        every = self.spark.read.parquet(self.folder).withColumn("stretch", F.col("stretch").cast("string"))
        kept = (F.col("is_open") == 0) & (F.col("stretch") <= newest) | (F.col("is_open") == 1) & (F.col("stretch") == newest)
        return every.filter(kept).drop("stretch", "is_open")


# --- exploration slices ----------------------------------------------------------------------------

def on_latest_date(features: DataFrame, day: date | None = None) -> DataFrame:
    """Rows of the newest observation date: ``day``, the end of the spine, where every entity has a row on every date."""
    newest = F.lit(day) if day else features.select(F.max("observation_date")).scalar()
    return features.filter(F.col("observation_date") == newest)


def recent_rfm(rfm: DataFrame, today: date, days: int = 5, k: int = 20) -> DataFrame:
    since = F.date_sub(F.lit(today), days)
    return rfm.filter(F.col("observation_date") >= since).orderBy(
        F.col("observation_date").desc(), "customer_id").limit(k)


def high_revenue_products(performance: DataFrame, least: int = 10_000_000, k: int = 20, day: date | None = None) -> DataFrame:
    return on_latest_date(performance, day).filter(F.col("cumulative_revenue") > least).orderBy(
        "revenue_rank", "product_id").limit(k)


def top_reps(quota: DataFrame, k: int = 20, day: date | None = None) -> DataFrame:
    return on_latest_date(quota, day).orderBy(F.col("quota_attainment_ratio").desc_nulls_last(), "rep_id").limit(k)


def reps_on(quota: DataFrame, day: date) -> DataFrame:
    return quota.filter(F.col("observation_date") == F.lit(day)).select(
        "rep_id", "quota_attainment_pct", "ytd_revenue").orderBy(
        F.col("quota_attainment_pct").desc_nulls_last(), "rep_id")


def churn_recipe(training: DataFrame, first: date, last: date, least_recency: int = 30) -> DataFrame:
    return training.filter(F.col("observation_date").between(F.lit(first), F.lit(last))
                           & (F.col("recency_days") > least_recency))


def churn_recipe_stretches(training: Stretches, first: date, last: date, least_recency: int = 30) -> Stretches:
    """``churn_recipe`` on stretches: from the day on which the recency exceeds the least."""
    beyond = F.date_add("_from", F.greatest(F.lit(0), F.lit(least_recency + 1) - F.col("recency_days")))
    return training.between(first, last).since(beyond)


def demand_recipe(training: DataFrame, first: date, last: date, least_revenue: int = 1_000_000) -> DataFrame:
    return training.filter(F.col("observation_date").between(F.lit(first), F.lit(last))
                           & (F.col("cumulative_revenue") > least_revenue))
