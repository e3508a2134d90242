from pyspark.sql import functions as F

from lodework.operators import sinks
from tests.conftest import rows


def test_replace_and_append(spark, folder):
    sinks.replace(spark.range(3), folder)
    sinks.replace(spark.range(2), folder)
    assert sinks.append(spark.range(5, 6), folder).count() == 3


def test_ids_continue(spark, folder):
    log = spark.createDataFrame([("b",), ("a",)], "task string")
    sinks.append_numbered(log, folder, "id", ["task"])
    assert rows(sinks.append_numbered(log, folder, "id", ["task"])) == [(1, "a"), (2, "b"), (3, "a"), (4, "b")]


def test_merge(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(sinks.merge(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(sinks.merge(old, new, ["k"], update=False)) == [(1, "a"), (2, "b"), (3, "C")]


def test_readers_keep_their_version(spark, folder):
    table = sinks.VersionedTable(spark, folder)
    assert table.read() is None
    first = table.write(spark.range(3))
    table.write(spark.range(5))
    assert first.count() == 3 and table.read().count() == 5


def test_clustered_files_do_not_overlap(spark, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = sinks.write_clustered(spark.range(10000).withColumn("day", F.col("id") % 100), folder, ("day",), ("id",))
        spans = stored.groupBy(F.input_file_name()).agg(F.min("day").alias("a"), F.max("day").alias("b")).orderBy("a").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(spans) > 1 and all(x.b <= y.a for x, y in zip(spans, spans[1:]))
