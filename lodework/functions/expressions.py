"""Column expressions shared by the layers. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def money(column: Column | str) -> Column:
    """Two-digit decimal: sums are exact and do not depend on row order."""
    return _col(column).cast("decimal(18,2)")


def moment(at: datetime) -> Column:
    """A wall-clock literal that does not depend on the session time zone."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def ratio(num: Column, den: Column, digits: int, times: int = 1) -> Column:
    """``times * num / den`` in exact decimals, rounded half up; NULL when den is 0."""
    scaled = num.cast("decimal(24,2)") * F.lit(times).cast("decimal(3,0)")
    divisor = F.nullif(den.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)"))
    quotient = scaled.cast("decimal(26,2)") / divisor
    return F.round(quotient, digits).cast(f"decimal(24,{digits})")


def mean(total: Column, count: Column, digits: int = 2) -> Column:
    return ratio(total, count, digits)


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return ratio(part, whole, digits, times=100)


def growth_pct(current: Column, previous: Column, digits: int = 2) -> Column:
    """Relative change in percent; NULL without a previous value or when it is 0."""
    return ratio(current - previous, previous, digits, times=100)


def growth_over(value: str, window: WindowSpec, previous: str, growth: str) -> dict[str, Column]:
    """The lagged value and its growth as two named columns over one window."""
    lagged = F.lag(value).over(window)
    return {previous: lagged, growth: growth_pct(F.col(value), lagged)}


def std_pop_cents(n: Column, total_cents: Column, squares: Column) -> Column:
    """Population standard deviation in cents from exact sums, rounded half up.

    n * sum(x^2) - sum(x)^2 is an exact integer, so the result does not depend on
    the order in which partial aggregates are merged.
    """
    spread = (
        n.cast("decimal(9,0)") * squares.cast("decimal(28,0)")
        - total_cents.cast("decimal(18,0)") * total_cents.cast("decimal(18,0)")
    )
    return F.floor(F.sqrt(spread.cast("double")) / n.cast("double") + F.lit(0.5))


def band(value: Column, steps: Sequence[tuple[object, str]], otherwise: str, op: str = "ge") -> Column:
    """First matching label of ``value <op> threshold``; NULL falls to ``otherwise``."""
    tests = {
        "ge": lambda t: value >= F.lit(t),
        "gt": lambda t: value > F.lit(t),
        "le": lambda t: value <= F.lit(t),
        "lt": lambda t: value < F.lit(t),
    }
    chain = None
    for threshold, label in steps:
        condition = tests[op](threshold)
        chain = F.when(condition, label) if chain is None else chain.when(condition, label)
    return chain.otherwise(otherwise)


def decode(value: Column, labels: dict[str, str], otherwise: str) -> Column:
    chain = None
    for code, label in labels.items():
        chain = F.when(value == code, label) if chain is None else chain.when(value == code, label)
    return chain.otherwise(otherwise)


def at_least_zero(column: Column) -> Column:
    """GREATEST(x, 0) that keeps NULL, unlike Spark's NULL-skipping greatest."""
    zero = F.lit(0).cast("decimal(18,2)")
    return F.when(column.isNotNull(), F.greatest(column, zero))


def upper_trim(column: Column | str) -> Column:
    return F.upper(F.trim(_col(column)))


def last_word(column: Column | str) -> Column:
    return F.split_part(_col(column), F.lit(" "), F.lit(-1))


def digits_as_id(column: Column | str) -> Column:
    """The first run of digits as a number, NULL when there is none."""
    return F.regexp_substr(_col(column), F.lit("[0-9]+")).try_cast("bigint")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def months_between_boundaries(start: Column, end: Column) -> Column:
    """Number of month boundaries crossed, not of whole months."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def years_between_boundaries(start: Column, end: Column) -> Column:
    return F.year(end) - F.year(start)


def hours_between_boundaries(start: Column, end: Column) -> Column:
    return F.timestamp_diff("HOUR", F.date_trunc("hour", start), F.date_trunc("hour", end))


def month_start(column: Column | str) -> Column:
    return F.trunc(_col(column), "MM")


def calendar(day: Column) -> dict[str, Column]:
    """Calendar attributes of a date; used instead of a join to a date table."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "quarter": F.quarter(day),
        "week_of_year": F.weekofyear(day),
        "day_of_year": F.dayofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_name": F.date_format(day, "EEE"),
        "month_name": F.date_format(day, "MMMM"),
        "year_month": F.date_format(day, "yyyy-MM"),
        "is_weekday": ~F.dayofweek(day).isin(1, 7),
    }


def month_calendar(day: Column) -> dict[str, Column]:
    """The attributes that are constant within a month."""
    attributes = calendar(day)
    return {name: attributes[name] for name in ("year", "month", "month_name", "year_month", "quarter")}


def column_or_null(df: DataFrame, name: str, data_type: str) -> Column:
    """A source column, or a typed NULL where the source does not carry it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(data_type)


def uncompiled(column: Column) -> Column:
    """The same column by way of a function that Spark generates no code for; for a branch that few rows take.

    A projection with it stays out of the method of its stage and is generated in small pieces. The JVM does not
    compile methods above 8,000 bytes, and a stage with such a method runs many times slower.
    """
    return F.get(F.transform(F.array(column), lambda c: c), F.lit(0))


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
