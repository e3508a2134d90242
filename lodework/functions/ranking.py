"""Order statistics and ranks over groups of any size, without putting a group into one task.

Three needs, four ways, each the same at every size:

* ``first_at``: the rows that stand at given places of a group's order (limits of fifths,
  percentiles). Counts per value decide: a coarse histogram names the interval that holds
  a place, a second count its value, and only rows of that value are ordered by their key.
  Rows may carry a weight, so that a row can stand for many equal ones.
* ``narrowed``: the same places where the rows are made anew for every look and are too many
  to be dealt by value: interval by interval, then by finer ones, and only the values of the
  finest are told apart.
* ``dense_ranked``: ranks inside order-preserving intervals of the value, shifted by the
  number of distinct values in the intervals before.
* ``numbered``: one range shuffle on the full sort key, the place inside a written
  partition, and one offset per partition.

The intervals are a function of the value alone (``coarse``), so that every task of every
attempt puts a row into the same one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodework import session

#: Intervals per doubling of the value; a double has some 2,000 doublings, money in cents about 90.
RESOLUTION = 16


@dataclass(frozen=True)
class By:
    """A ranked column: NULLs come last when ascending and first when descending."""

    name: str
    descending: bool = False

    @property
    def sort(self) -> Column:
        column = F.col(self.name)
        return column.desc_nulls_first() if self.descending else column.asc_nulls_last()

    def interval(self, resolution: int) -> Column:
        """Ascending numbers of intervals that follow the order; NULLs have one of their own."""
        number = coarse(F.col(self.name), resolution)
        least, most = -(1 << 31), (1 << 31) - 1
        return F.coalesce(-number if self.descending else number, F.lit(least if self.descending else most))


def coarse(value: Column, resolution: int) -> Column:
    """An integer that never falls when the value rises: sign and logarithm of the number."""
    number = value.cast("double")
    size = (F.floor(F.log2(F.abs(number) + 1) * resolution) + 1).cast("int")
    return F.when(number > 0, size).when(number < 0, -size).when(number == 0, 0)


def pick(left: DataFrame, right: DataFrame, columns: Sequence[str], kept: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose ``columns`` match a row of ``right``, with ``kept`` of ``right``.

    ``right`` has one row per group and place. The groups are few (the months of a calendar,
    the axes of a score), so it is broadcast.
    """
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") for c in columns], *kept)
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(renamed[f"_r_{c}"])
    return left.join(F.broadcast(renamed), condition).drop(*[f"_r_{c}" for c in columns])


# --- the rows at given places ------------------------------------------------------------------

def fifths(total: Column) -> Column:
    """Places (number, 0-based position) at which the second to fifth fifth of ``total`` rows begin.

    The first ``total % 5`` fifths hold one row more; fifths that are empty begin nowhere.
    """
    begins = [F.struct(F.lit(b).alias("place"), (F.floor(total / 5) * b + F.least(F.lit(b), total % 5)).cast("bigint").alias("position"))
              for b in range(1, 5)]
    return F.filter(F.array(*begins), lambda p: p["position"] < total)


def at_shares(*shares: str) -> Callable[[Column], Column]:
    """Places of the last rows whose percent rank may lie below the shares: a higher value lies above."""
    def places(total: Column) -> Column:
        up_to = [F.greatest(F.lit(1), F.ceil(F.lit(s).cast("decimal(6,4)") * (total - 1))).cast("bigint") - 1 for s in shares]
        return F.array(*[F.struct(F.lit(i + 1).alias("place"), p.alias("position")) for i, p in enumerate(up_to)])
    return places


def _located(values: DataFrame, level: Sequence[By], group: Sequence[str], places: Callable[[Column], Column] | None,
             resolution: int) -> DataFrame:
    """The row of ``values`` that holds each place of its group, and ``rest``, the position in it.

    values: one row per group and distinct values of the level, standing for ``_n`` rows,
    and ``rest``, the position looked for, unless ``places`` of the group's total say it.
    Windows run over the intervals of a group, and over the values of one interval.
    """
    placed = values.withColumn("_interval", level[0].interval(resolution))
    asked = [] if places else ["rest"]
    totals = placed.groupBy(*group, *asked, "_interval").agg(F.sum("_n").alias("_in"))
    whole = Window.partitionBy(*group)
    run = totals.withColumns({"_before": F.sum("_in").over(whole.orderBy("_interval")) - F.col("_in"),
                              "_total": F.sum("_in").over(whole)})
    if places:
        run = run.withColumn("_place", F.explode(places(F.col("_total")))).select(
            *group, "_interval", "_in", "_before", F.col("_place.place").alias("place"), F.col("_place.position").alias("rest"))
    at = F.col("rest") - F.col("_before")
    hit = run.filter((at >= 0) & (at < F.col("_in"))).withColumn("_at", at)
    group = [*group, "place"] if places else list(group)
    found = pick(placed.drop(*asked), hit, [c for c in group if c in placed.columns] + ["_interval"],
                 ["place", "_at"] if places else ["_at"])
    in_order = Window.partitionBy(*group).orderBy(*[by.sort for by in level])
    into = F.col("_at") - F.col("_before")
    return found.withColumn("_before", F.sum("_n").over(in_order) - F.col("_n")).filter(
        (into >= 0) & (into < F.col("_n"))).select(*group, *[by.name for by in level], into.alias("rest"))


def first_at(rows: DataFrame, levels: Sequence[Sequence[By]], within: Sequence[str],
             places: Callable[[Column], Column], *, weight: str | None = None, resolution: int = RESOLUTION) -> DataFrame:
    """Per group and place, the columns of the row at that place and ``rest``, its position among rows equal in them.

    levels: the order; each level is narrowed by its first column, so a level of its own
    pays for columns that many rows share. places: total -> array of (place, 0-based position).
    A row counts ``weight`` times (once without). The number of groups must be bounded.
    Every level takes one pass over the rows; what follows are their counts.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    names = [by.name for by in levels[0]]
    found = _located(rows.groupBy(*within, *names).agg(n.alias("_n")), levels[0], within, places, resolution)
    for level in levels[1:]:
        candidates = pick(rows, found, [*within, *names], ["place", "rest"])
        found = among(candidates, level, [*within, *names], n=n, resolution=resolution)
        names += [by.name for by in level]
    return found


def among(candidates: DataFrame, level: Sequence[By], within: Sequence[str], *, n: Column, resolution: int = RESOLUTION) -> DataFrame:
    """The next level inside rows that carry their ``place`` and the ``rest`` looked for; ``n`` counts them."""
    group = [*within, "place"]
    values = candidates.groupBy(*group, "rest", *[by.name for by in level]).agg(n.alias("_n"))
    return _located(values, level, group, None, resolution)


#: A finer interval is this share of the one before.
FINER = 64


def narrowed(counts: DataFrame, within: Sequence[str], order: Sequence[Column], asked: Sequence[str],
             places: Callable[[Column], Column] | None = None) -> DataFrame:
    """Parts of groups that hold a place, with the position in the part under the name of the place; NULL if it holds it not.

    counts: one row per group and part, ``_n`` rows in it, and the positions ``asked`` of the group,
    place by place, unless ``places`` of the group's total say them. Parts of a group are few.
    """
    group = Window.partitionBy(*within)
    run = counts.withColumn("_before", F.sum("_n").over(group.orderBy(*order)) - F.col("_n"))
    if places:
        run = run.withColumn("_places", places(F.sum("_n").over(group)))
        run = run.withColumns({name: F.get(F.filter("_places", lambda p: p["place"] == i), F.lit(0))["position"]
                               for i, name in enumerate(asked, 1)}).drop("_places")
    into = {name: F.col(name) - F.col("_before") for name in asked}
    held = run.withColumns({name: F.when((at >= 0) & (at < F.col("_n")), at) for name, at in into.items()})
    return held.filter(F.coalesce(*asked).isNotNull()).drop("_n", "_before")


def side_by_side(found: DataFrame, within: Sequence[str], columns: Sequence[str], places: int, key: str | None = None,
                 keys: Sequence = (None,)) -> DataFrame:
    """One row per group: a struct of ``columns`` per place, named l1, l2, ... or <key>1, <key>2, ..."""
    told = F.struct(*columns)
    made = []
    for k in keys:
        for p in range(1, places + 1):
            here = F.col("place") == p if k is None else (F.col("place") == p) & (F.col(key) == k)
            made.append(F.max(F.when(here, told)).alias(f"{k or 'l'}{p}"))
    return found.groupBy(*within).agg(*made)


def beside(df: DataFrame, row: DataFrame, name: str) -> DataFrame:
    """``df`` with the only row of another table as a struct; computed once, however often its fields are read."""
    return df.withColumn(name, row.select(F.struct("*")).scalar())


# --- dense ranks ---------------------------------------------------------------------------------

def placed(df: DataFrame, by: By, resolution: int = RESOLUTION) -> DataFrame:
    """``df`` with the interval of the ranked value and the value as a double, by which most rows are told apart in a sort.

    Done before rows are multiplied, it is not done per row.
    """
    return df.withColumns({"_interval": by.interval(resolution), "_near": F.col(by.name).cast("double")})


def dense_ranked(df: DataFrame, name: str, by: By, within: Sequence[str] = (), *, distinct: DataFrame | None = None,
                 resolution: int = RESOLUTION) -> DataFrame:
    """Add the dense rank of a column within a group.

    Rows are ranked inside (group, interval); the distinct values of the intervals before
    are added. ``distinct`` (within, _interval, _n) gives the numbers of distinct values
    where the caller knows a cheaper way to them. The group's columns hold no NULL, so that
    ranks and numbers meet in the partitions of one shuffle.
    """
    rows = df if "_interval" in df.columns else placed(df, by, resolution)
    if distinct is None:
        distinct = rows.groupBy(*within, "_interval", by.name).agg(F.lit(1).alias("_one")).groupBy(
            *within, "_interval").agg(F.count("_one").alias("_n"))
    # As many rows per group as there are intervals.
    upto = Window.partitionBy(*within).orderBy("_interval")
    before = distinct.select(*[F.col(c).alias(f"_b_{c}") for c in (*within, "_interval")],
                             (F.sum("_n").over(upto) - F.col("_n")).alias("_before"))
    local = rows.withColumn("_rank", F.dense_rank().over(
        Window.partitionBy(*within, "_interval").orderBy(By("_near", by.descending).sort, by.sort)).cast("bigint"))
    condition = local["_interval"] == before["_b__interval"]
    for c in within:
        condition = condition & (local[c] == before[f"_b_{c}"])
    joined = local.join(before, condition)
    kept = [c for c in df.columns if c not in (name, "_interval", "_near")]
    return joined.select(*kept, (F.col("_before") + F.col("_rank")).cast("bigint").alias(name))


# --- numbers over a whole table ------------------------------------------------------------------

#: ``monotonically_increasing_id``: partition number above these bits, place in the partition below.
_PLACE_BITS = 33


def numbered(df: DataFrame, name: str, order_by: Sequence[By], ties: Sequence[str] = (), *, start: int = 1) -> DataFrame:
    """Add row numbers in the order of ``order_by`` and then ``ties``; rows equal in both are numbered arbitrarily.

    One range shuffle. The sorted partitions are written to the shared folder with the
    partition's number and the place in it, and the offsets are counted on what was
    written, so a task that runs again cannot move a row. The offsets are one row per
    partition, which bounds their broadcast.
    """
    keys = [*[o.sort for o in order_by], *[F.col(c).asc_nulls_last() for c in ties]]
    path = session.work_dir(df.sparkSession, "numbered")
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField("_at", T.LongType())])
    written = df.sparkSession.read.schema(schema).parquet(path)
    part = F.shiftright("_at", _PLACE_BITS)
    counts = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset"))
    joined = written.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    place = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    kept = [c for c in df.columns if c != name]
    return joined.select(*kept, (F.col("_offset") + place + start).alias(name))
