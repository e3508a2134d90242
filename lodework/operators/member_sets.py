"""Distinct counts that can be added up: per cell the set of members as a bitmap, not their number.

Distinct customers of two months are not the sum of both months. A stored set per cell
answers every coarser grain exactly, by uniting the sets of its cells, without reading
the lines again. A set is cut into ranges of 32,768 keys, one bitmap each, so no cell is
a single row however many members it has, and uniting combines inside the tasks first.

Members are whole numbers (BIGINT); NULL is no member, but its amounts are counted.
Bitmaps suit keys that are numbered densely: a cell with few members in a range still
holds a bitmap of 4 KB for it, which compresses to little when it is stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE = "member_range"
MEMBERS = "members"


def cells(rows: DataFrame, keys: Sequence[str], member: str, amount: str) -> DataFrame:
    """``keys, member_range, members, amount``: the members of each cell by key range, and what they amount to.

    Rows are first reduced to one per cell and member, so a member with very many rows
    is combined before it moves; then a range of a cell has at most 32,768 rows.
    """
    key = F.col(member).cast("bigint")
    reduced = rows.withColumn(member, key).groupBy(*keys, member).agg(F.sum(amount).alias(amount))
    placed = reduced.withColumn(RANGE, F.bitmap_bucket_number(member))
    # Both groupings below need only this exchange: bitmaps are made where they stay.
    dealt = placed.repartition(*[F.col(k) for k in (*keys, RANGE)])
    return dealt.groupBy(*keys, RANGE).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(member)).alias(MEMBERS), F.sum(amount).alias(amount))


def count_members(sets: DataFrame, grain: Sequence[str | Column], amount: str, count_name: str) -> DataFrame:
    """Exact distinct members and the amount of every group of ``grain``, from stored cells.

    ``grain`` is any columns or expressions that the cell keys determine.
    """
    united = sets.groupBy(*grain, RANGE).agg(F.bitmap_or_agg(MEMBERS).alias(MEMBERS), F.sum(amount).alias(amount))
    names = [c for c in united.columns if c not in (RANGE, MEMBERS, amount)]
    # Without a member there is an empty set, which counts nothing.
    return united.groupBy(*names).agg(F.sum(F.bitmap_count(MEMBERS)).alias(count_name), F.sum(amount).alias(amount))
