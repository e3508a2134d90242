"""Feature tables as stretches of observation dates.

Most values of a feature table hold from one change to the next, and the others rise by one
a day. A stretch is one row for such a run of dates: the values on its first date, ``_from``
and ``_until``. Sums, counts, extremes, changes and correlations over all dates follow from
stretches without their days; ``daily`` generates the days where a reader wants the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodework.functions import expressions as X

_BOUNDS = ("_from", "_until")


@dataclass(frozen=True)
class Stretches:
    """rows: columns, ``_from``, ``_until``; spine: the observation dates; rising: columns that rise by one a day."""

    rows: DataFrame
    spine: object
    rising: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if c not in _BOUNDS]

    def of(self, rows: DataFrame) -> Stretches:
        return replace(self, rows=rows, rising=tuple(c for c in self.rising if c in rows.columns))

    def select(self, *columns) -> Stretches:
        return self.of(self.rows.select(*columns, *_BOUNDS))

    def since(self, day: Column) -> Stretches:
        """The dates from ``day`` on, a column of the rows; none where it is NULL."""
        return self.of(_moved(self.of(self.rows.filter(day.isNotNull())), self.spine.at_or_after(day)))

    def between(self, first: date, last: date) -> Stretches:
        """The dates of a closed range."""
        later = self.since(F.lit(first)).rows
        return self.of(later.withColumn("_until", F.least("_until", F.lit(last))).filter(F.col("_from") <= F.col("_until")))

    def cut(self, *days: Column) -> Stretches:
        """Cut so that a stretch never goes on over one of ``days``; each begins a stretch of its own.

        days: an array, or columns of one day each. Of columns, a stretch with none of them inside makes no list.
        Stretches of a monthly spine hold one date each before they are cut.
        """
        inside = lambda d: (d > F.col("_from")) & (d <= F.col("_until"))
        days = [F.col(d) if isinstance(d, str) else d for d in days]
        if len(days) == 1:
            starts = F.sort_array(F.array_distinct(F.concat(F.array("_from"), F.filter(days[0], inside))))
        else:
            none = F.array(F.lit(None).cast("date"))
            some = X.uncompiled(F.sort_array(F.array_except(F.array("_from", *[F.when(inside(d), d) for d in days]), none)))
            met = [F.coalesce(inside(d), F.lit(False)) for d in days]
            starts = F.when(reduce(or_, met), some).otherwise(F.array("_from"))
        # There is always a start; the outer form spares the planner a condition that says so in terms of all the days.
        begun = self.rows.withColumn("_starts", starts).select("*", F.posexplode_outer("_starts").alias("_at", "_start"))
        ends = F.coalesce(F.date_sub(F.get("_starts", F.col("_at") + 1), 1), F.col("_until"))
        kept = begun.withColumn("_until", ends).withColumn("_rise", F.datediff("_start", "_from"))
        risen = {c: (F.col(c) + F.col("_rise")).cast(self.rows.schema[c].dataType) for c in self.rising}
        return self.of(kept.withColumns({**risen, "_from": F.col("_start")}).drop("_starts", "_at", "_start", "_rise"))

    def in_months(self) -> Stretches:
        """Cut at the ends of months."""
        month = F.make_ym_interval(months=F.lit(1))
        cut = self.rows.select("*", F.explode(F.sequence(F.trunc("_from", "MM"), F.trunc("_until", "MM"), month)).alias("_month"))
        ends = F.last_day("_month") if self.spine.step == "day" else F.col("_month")
        begun = F.greatest("_from", "_month")
        risen = {c: (F.col(c) + F.datediff(begun, "_from")).cast(self.rows.schema[c].dataType) for c in self.rising}
        return self.of(cut.withColumns({**risen, "_from": begun, "_until": F.least(F.col("_until"), ends)}).drop("_month"))

    @property
    def n(self) -> Column:
        """The number of dates of a stretch."""
        return self.spine.count(F.col("_from"), F.col("_until"))

    def last(self, column: str) -> Column:
        return F.col(column) + F.datediff("_until", "_from") if column in self.rising else F.col(column)

    def total(self, column: str) -> Column:
        """The sum of a column over the dates of a stretch."""
        if column not in self.rising:
            return F.col(column) * self.n
        return (F.floor((F.col(column) + self.last(column)).cast("bigint") * self.n / 2)).cast("bigint")

    def daily(self, key: str) -> DataFrame:
        """One row per date; generated in place, no shuffle."""
        dates = F.explode(self.spine.dates(F.col("_from"), F.col("_until"))).alias("observation_date")
        dated = self.rows.select("*", dates)
        kept = [c for c in self.columns if c != key]
        told = [(F.col(c) + F.datediff("observation_date", "_from")).cast(self.rows.schema[c].dataType).alias(c)
                if c in self.rising else F.col(c) for c in kept]
        return dated.select(key, "observation_date", *told)


def _moved(s: Stretches, day: Column) -> DataFrame:
    """Rows that begin no earlier than ``day``, an observation date; those that end before it are gone."""
    begun = F.greatest(F.col("_from"), day)
    risen = {c: (F.col(c) + F.datediff(begun, "_from")).cast(s.rows.schema[c].dataType) for c in s.rising}
    return s.rows.withColumns({**risen, "_from": begun}).filter(F.col("_from") <= F.col("_until"))


def dealt_by_month(s: Stretches, key: str) -> Stretches:
    """Stretches within months, each with its ``_month``, dealt by entity and month.

    They move before they are summed, so a task holds the months of the rows it has read. Cut
    and summed in one task, a small input becomes all its months.
    """
    cut = s.in_months()
    return cut.of(cut.rows.withColumn("_month", F.trunc("_from", "MM")).repartition(key, "_month"))


def per_month(s: Stretches, key: str, labels: Mapping[str, Sequence[str]] = {}, months: Sequence[str] = ()) -> DataFrame:
    """Per entity and month the number of dates, and of every column its sum, least and greatest value.

    Stretches lie within months. A month's sums are exact decimals, so they equal those over its days.
    Of stretches dealt by month, the column is its first day, ``_month``. Texts make Spark sort the rows
    before it sums them, so those of which all values are known (``labels``) are summed as their places
    in that list, and those that name the month (``months``) are not.
    """
    dealt = "_month" in s.columns
    shown, made = [F.sum(s.n).alias("n")], ["n"]
    whole = s.n.cast("decimal(4,0)")
    for name in s.columns:
        kind = s.rows.schema[name].dataType
        if name in (key, "_month"):
            continue
        if name in months:
            made += [F.date_format("_month", "yyyy-MM").alias(f"{name}_{which}") for which in ("min", "max")]
            continue
        least, most = F.col(name), s.last(name)
        if isinstance(kind, T.NumericType):
            if name in s.rising:
                sum_ = F.sum((least + most).cast("bigint") * s.n).cast("decimal(28,4)") / 2
            elif isinstance(kind, T.IntegralType):
                sum_ = F.sum(least.cast("bigint") * s.n)
            elif isinstance(kind, T.DecimalType) and kind.precision <= 28 and kind.scale <= 4:
                sum_ = F.sum(least * whole)
            else:
                sum_ = F.sum(least.cast("decimal(28,4)") * whole)
            shown.append(sum_.cast("double").alias(f"{name}_sum"))
            made.append(f"{name}_sum")
            least, most = least.cast("double"), most.cast("double")
        elif isinstance(kind, T.DateType):
            least, most = least.cast("string"), most.cast("string")
        elif name in labels:
            known = sorted(labels[name])
            places = F.array(*[F.lit(v) for v in known])
            place = reduce(lambda chain, i: chain.when(F.col(name) == known[i], i), range(1, len(known)), F.when(F.col(name) == known[0], 0))
            shown += [F.min(place).alias(f"{name}_min"), F.max(place).alias(f"{name}_max")]
            made += [F.get(places, F.col(f"{name}_{which}")).alias(f"{name}_{which}") for which in ("min", "max")]
            continue
        shown += [F.min(least).alias(f"{name}_min"), F.max(most).alias(f"{name}_max")]
        made += [f"{name}_min", f"{name}_max"]
    month = F.col("_month") if dealt else F.trunc("_from", "MM").alias("_month")
    summed = s.rows.groupBy(key, month).agg(*shown)
    return summed.select(key, "_month" if dealt else F.date_format("_month", "yyyy-MM").alias("month"), *made)


def row_count(table: DataFrame | Stretches) -> DataFrame:
    """One row ``n``: the rows of a table, or of the table that stretches stand for."""
    if isinstance(table, Stretches):
        return table.rows.agg(F.coalesce(F.sum(table.n), F.lit(0)).cast("bigint").alias("n"))
    return table.agg(F.count(F.lit(1)).alias("n"))


def coverage(s: Stretches, key: str) -> DataFrame:
    """Rows, entities, dates and span of the table that stretches stand for: one row.

    Stretches of one start are first reduced to the longest, at most one per date, so only
    days of the calendar are generated.
    """
    longest = s.rows.groupBy("_from").agg(F.max("_until").alias("_until"), F.sum(s.n).alias("_n"))
    days = longest.select(F.explode(s.spine.dates(F.col("_from"), F.col("_until"))).alias("day")).agg(
        F.count_distinct("day").alias("date_snapshots"))
    span = longest.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"), F.min("_from").alias("earliest_date"),
                       F.max("_until").alias("_until"))
    entities = s.rows.agg(F.count_distinct(key).alias("unique_entities"))
    latest = F.col("_until") if s.spine.step == "day" else F.trunc("_until", "MM")
    return span.select(
        "total_rows", entities.scalar().alias("unique_entities"), days.scalar().alias("date_snapshots"),
        "earliest_date", latest.alias("latest_date"), F.datediff(latest, "earliest_date").alias("days_covered"))

