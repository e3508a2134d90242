import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodework.functions.ranking import By, at_shares, dense_ranked, fifths, first_at, narrowed, numbered, side_by_side
from tests.conftest import rows


@pytest.fixture(scope="module")
def values(spark):
    """Ties, NULLs, negative values, one value holding half of the rows, and groups of different size."""
    key = F.col("id")
    value = F.when(key % 7 == 0, None).when(key % 2 == 0, 5).otherwise((key * 37 % 11 - 4) * (key % 3 + 1))
    made = spark.range(1500).select(key.alias("k"), F.when(key < 3, 9).otherwise(key % 3).alias("g"), value.alias("v"))
    return made.withColumn("w", F.pmod("k", F.lit(4)))


def split_at(found, place_columns):
    return sorted(tuple(r[c] for c in place_columns) for r in found.collect())


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("resolution", [1, 16])
def test_fifths_begin_where_ntile_steps(values, descending, resolution):
    by = By("v", descending)
    numbers = Window.partitionBy("g").orderBy(by.sort, "k")
    told = values.withColumns({"n": F.ntile(5).over(numbers), "before": F.lag("k").over(numbers)})
    told = told.withColumn("prior", F.lag("n").over(numbers)).filter("n <> prior")
    expected = sorted((r.g, r.n - 1, r.v, r.k, 0) for r in told.collect())
    found = first_at(values, [[by], [By("k")]], ["g"], fifths, resolution=resolution)
    key = lambda t: (t[0], t[1])
    got = sorted(((r.g, r.place, r.v, r.k, r.rest) for r in found.collect()), key=key)
    assert got == sorted(expected, key=key)


def test_weights_stand_for_rows(values):
    spread = values.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("w") - 1, F.lit(1)))).filter("w > 0").drop("w")
    by = [[By("v")], [By("k")]]
    one = first_at(values.filter("w > 0"), by, ["g"], fifths, weight="w")
    two = first_at(spread, [[By("v")], [By("k"), By("i")]], ["g"], fifths)
    assert rows(one, "g", "place", "v", "k", "rest") == rows(two.withColumn("rest", F.col("i")), "g", "place", "v", "k", "rest")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 9, 1500])
def test_bands_of_percent_ranks(values, n):
    some = values.filter(F.col("k") < n).select("k", "v")
    percent = F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_last()))
    shares = ("0.75", "0.5", "0.25")
    expected = rows(some.select("k", *[(percent >= float(s)).alias(s) for s in shares]))
    limits = side_by_side(first_at(some, [[By("v")]], [], at_shares(*shares)), [], ["v"], 3).first()
    order = lambda v: (v is None, v or 0)
    got = [(r.k, *[limits[f"l{i}"] is not None and order(r.v) > order(limits[f"l{i}"].v) for i in (1, 2, 3)]) for r in some.collect()]
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("within", [[], ["g"]])
@pytest.mark.parametrize("descending", [False, True])
def test_dense_ranks_equal_a_window(values, within, descending):
    by = By("v", descending)
    expected = values.withColumn("r", F.dense_rank().over(Window.partitionBy(*within).orderBy(by.sort)).cast("bigint"))
    assert rows(dense_ranked(values, "r", by, within)) == rows(expected)


def test_a_hot_group_is_ranked_by_many_tasks(spark):
    hot = spark.range(20000).select(F.lit(1).alias("g"), (F.col("id") * F.col("id")).alias("v"))
    ranked = dense_ranked(hot, "r", By("v"), ["g"])
    assert ranked.select(F.spark_partition_id()).distinct().count() > 1
    assert ranked.filter("r <> sqrt(v) + 1").count() == 0


def test_numbers_equal_a_window(spark, values):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = Window.orderBy(F.col("v").desc_nulls_first(), "k")
        got = numbered(values, "n", [By("v", True)], ["k"], start=11)
        assert rows(got) == rows(values.withColumn("n", F.row_number().over(order) + 10))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "row_number" not in plan and "rangepartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_tables(values):
    none = values.filter("k < 0")
    assert first_at(none, [[By("v")], [By("k")]], ["g"], fifths).count() == 0
    assert dense_ranked(none, "r", By("v"), ["g"]).count() == 0
    assert numbered(none, "n", [By("v")]).count() == 0


def test_narrowed_places_equal_those_of_the_rows(spark):
    values = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 101).alias("v"))
    asked = ["r1", "r2", "r3", "r4"]
    tens = values.withColumn("t", F.floor(F.col("v") / 10)).groupBy("g", "t").agg(F.count("v").alias("_n"))
    near = narrowed(tens, ["g"], ["t"], asked, fifths)
    met = values.withColumn("t", F.floor(F.col("v") / 10)).join(near, ["g", "t"])
    found = narrowed(met.groupBy("g", "t", *asked, "v").agg(F.count("v").alias("_n")), ["g", "t"], ["v"], asked)
    at = F.inline(F.array(*[F.struct(F.lit(i).alias("place"), F.col(c).alias("rest")) for i, c in enumerate(asked, 1)]))
    told = found.select("g", "v", at).filter("rest IS NOT NULL")
    assert rows(told, "g", "place", "v", "rest") == rows(first_at(values, [[By("v")]], ["g"], fifths), "g", "place", "v", "rest") != []
