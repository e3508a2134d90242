"""Dense ranks of every day, summed per entity and month without their days moving.

The rank of an entity changes with the values of all others, so it has no stretches of its own.
What moves are the stretches, cut at the ends of months: one cell is a month and an interval of
the value, and a task reads the rows of its cells in the order of the value. Per day of the month
it holds two numbers, the distinct values so far and whether the current one was met, so memory
does not grow with the rows of a cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodework.functions.ranking import By
from lodework.operators.stretches import Stretches

_DAYS = np.arange(31)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _values(column: pa.Array) -> np.ndarray:
    """Three numbers per decimal that are equal where the decimals are: two halves, and whether it is NULL."""
    halves = np.frombuffer(column.buffers()[1], "<i8").reshape(-1, 2)[column.offset:column.offset + len(column)]
    unknown = column.is_null().to_numpy(zero_copy_only=False)
    return np.column_stack([np.where(unknown[:, None], 0, halves), unknown])


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, the days' offsets first, then by value: per row the sum, least and greatest rank of its days."""
    cell = last = None
    for batch in batches:
        months, intervals = _numbers(batch, "_month"), _numbers(batch, "_interval")
        is_part, first, until = _numbers(batch, "_is_part"), _numbers(batch, "_first"), _numbers(batch, "_last")
        before, values = _numbers(batch, "_before"), _values(batch.column("_value"))
        told = np.zeros((len(months), 3), "int64")
        changes = np.flatnonzero((np.diff(months) != 0) | (np.diff(intervals) != 0)) + 1
        for a, b in zip([0, *changes], [*changes, len(months)]):
            if a == b:
                continue
            if cell != (months[a], intervals[a]):
                cell, last = (months[a], intervals[a]), None
                so_far, met = np.zeros(31, "int64"), np.zeros(31, bool)
            h = a + int((is_part[a:b] == 0).sum())
            so_far[first[a:h]] = before[a:h]
            if h == b:
                continue
            alive = (_DAYS >= first[h:b, None]) & (_DAYS <= until[h:b, None])
            begins = np.ones(b - h, bool)
            begins[1:] = (values[h + 1:b] != values[h:b - 1]).any(axis=1)
            goes_on = last is not None and bool((values[h] == last).all())
            some = np.logical_or.reduceat(alive, np.flatnonzero(begins), axis=0)
            fresh = some.copy()
            if goes_on:
                fresh[0] &= ~met
                some[0] |= met
            upto = so_far + np.cumsum(fresh, axis=0)
            ranks = upto[np.cumsum(begins) - 1]
            told[h:b, 0] = np.where(alive, ranks, 0).sum(axis=1)
            told[h:b, 1] = np.where(alive, ranks, np.iinfo("int64").max).min(axis=1)
            told[h:b, 2] = np.where(alive, ranks, 0).max(axis=1)
            so_far, met, last = upto[-1], some[-1], values[b - 1]
        kept = pa.array(is_part == 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_key").filter(kept), batch.column("_month").filter(kept), batch.column("_n").filter(kept),
             *[pa.array(told[:, i]).filter(kept) for i in range(3)]],
            names=["_key", "_month", "_n", "_sum", "_min", "_max"])


def ranks_per_month(parts: Stretches, key: str, by: By, distinct: DataFrame, resolution: int) -> DataFrame:
    """Per entity and ``_month``: ``_n`` dates, and the ``_sum``, ``_min`` and ``_max`` of the dense ranks of all dates.

    parts: stretches within months. distinct: (_interval, observation_date, _n), the number of
    distinct values alive. The rows of ``distinct`` are bounded by the calendar and the intervals.
    """
    month_of = lambda day: F.unix_date(F.trunc(day, "MM"))
    place = lambda day: (F.dayofmonth(day) - 1).cast("int")
    upto = Window.partitionBy("observation_date").orderBy("_interval")
    # As many rows per date as there are intervals.
    offsets = distinct.withColumn("_before", (F.sum("_n").over(upto) - F.col("_n")).cast("bigint"))
    told = parts.rows.select(
        F.col(key).alias("_key"), F.col(by.name).alias("_value"), month_of("_from").alias("_month"),
        by.interval(resolution).alias("_interval"), place("_from").alias("_first"), place("_until").alias("_last"),
        parts.n.alias("_n"), F.lit(0).cast("bigint").alias("_before"), F.lit(1).alias("_is_part"),
        F.col(by.name).cast("double").alias("_near"))
    heads = offsets.select(
        F.lit(None).cast(told.schema["_key"].dataType).alias("_key"),
        F.lit(None).cast(told.schema["_value"].dataType).alias("_value"),
        month_of("observation_date").alias("_month"), "_interval", place("observation_date").alias("_first"),
        place("observation_date").alias("_last"), F.lit(0).cast("bigint").alias("_n"), "_before", F.lit(0).alias("_is_part"),
        F.lit(None).cast("double").alias("_near"))
    cells = told.unionByName(heads).repartition("_month", "_interval").sortWithinPartitions(
        "_month", "_interval", "_is_part", By("_near", by.descending).sort, By("_value", by.descending).sort)
    schema = T.StructType([T.StructField("_key", told.schema["_key"].dataType), T.StructField("_month", T.IntegerType()),
                           *[T.StructField(n, T.LongType()) for n in ("_n", "_sum", "_min", "_max")]])
    ranked = cells.mapInArrow(_ranked, schema)
    return ranked.groupBy(F.col("_key").alias(key), F.date_from_unix_date("_month").alias("_month")).agg(
        F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"), F.min("_min").alias("_min"), F.max("_max").alias("_max"))


def with_ranks(shown: DataFrame, ranks: DataFrame, key: str, name: str, after: str) -> DataFrame:
    """``stretches.per_month`` of rows dealt by month that have these ranks, with the columns of the rank behind those of ``after``.

    Where ``shown`` counts an entity's dates several times, its ranks count as often.
    """
    both = shown.join(ranks.withColumnRenamed("_n", "_dates"), [key, "_month"])
    times = (F.col("n") / F.col("_dates")).cast("bigint")
    rank = [(F.col("_sum") * times).cast("double").alias(f"{name}_sum"), F.col("_min").cast("double").alias(f"{name}_min"),
            F.col("_max").cast("double").alias(f"{name}_max")]
    at_ = shown.columns.index(f"{after}_max") + 1
    month = F.date_format("_month", "yyyy-MM").alias("month")
    return both.select(*[month if c == "_month" else c for c in shown.columns[:at_]], *rank, *shown.columns[at_:])
