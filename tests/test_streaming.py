import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F

from lodework.operators import silver, sinks
from lodework.plans.star import SalesModel
from lodework.streaming import incremental
from tests.conftest import SMALL, rows

AS_OF = date(2025, 1, 1)


def feeds_of(spark, root, schemas):
    return {n: incremental.change_feed(spark, f"{root}/in/{n}", s) for n, s in schemas.items()}


def test_stream_equals_batch_with_late_parents(spark, folder):
    bronze = SalesModel(spark, SMALL).bronze
    parts = {n: bronze[n] for n in ("customers", "orders", "order_items")}
    store = incremental.Store(spark, folder)
    late_customer = F.col("customer_id") >= 100
    late_order = F.col("order_id") % 2 == 0
    first = {"customers": parts["customers"].filter(~late_customer), "orders": parts["orders"].filter(~late_order),
             "order_items": parts["order_items"]}
    older = parts["customers"].withColumns({
        "segment": F.lit("stale"), "_loaded_at": F.col("_loaded_at") - F.expr("INTERVAL 1 DAY")})
    second = {"customers": parts["customers"].filter(late_customer).unionByName(older),
              "orders": parts["orders"].filter(late_order), "order_items": parts["order_items"].limit(0)}
    schemas = {n: df.schema for n, df in parts.items()}
    for arrival in (first, second):
        for name, df in arrival.items():
            df.coalesce(1).write.mode("append").parquet(f"{folder}/in/{name}")
        incremental.refresh_all(store, feeds_of(spark, folder, schemas), AS_OF)

    customers = silver.customers(parts["customers"])
    orders = silver.orders(parts["orders"], customers, AS_OF)
    items = silver.order_items(parts["order_items"], orders, None)
    assert rows(store.customers(), *customers.columns) == rows(customers)
    assert rows(store.accepted("orders"), *orders.columns) == rows(orders)
    assert rows(store.accepted("order_items"), *items.columns) == rows(items)
    # A row is written once, however long it waits, and what still waits has no parent.
    arrived = silver.valid_items(parts["order_items"])
    assert sinks.stored_rows(spark, store.folder("order_items")).count() == arrived.count()
    assert store.waiting("order_items").count() == arrived.count() - items.count()
    compacted = incremental.compact_customers(store, f"{folder}/compacted")
    assert rows(compacted.drop("_loaded_at"), *customers.columns) == rows(customers)


class Replayed(incremental.Store):
    """The same tables with checkpoints of their own, so that the first batch runs again."""

    def folder(self, name):
        return super().folder(f"again/{name}" if name.startswith("checkpoints/") else name)


def test_a_batch_that_runs_again_after_settling_accepts_rows_once(spark, folder):
    bronze = SalesModel(spark, SMALL).bronze
    store = incremental.Store(spark, folder)
    for name in ("orders", "customers"):
        bronze[name].coalesce(1).write.parquet(f"{folder}/in/{name}")
    feeds = feeds_of(spark, folder, {n: bronze[n].schema for n in ("customers", "orders")})
    incremental.refresh_orders(store, feeds["orders"], AS_OF).awaitTermination()
    assert store.accepted("orders").count() == 0
    incremental.refresh_customers(store, feeds["customers"]).awaitTermination()
    incremental.settle(store, "orders")
    incremental.settle(store, "orders")
    expected = rows(store.accepted("orders"))
    assert len(expected) == bronze["orders"].count()
    again = feeds_of(spark, folder, {"orders": bronze["orders"].schema})["orders"]
    incremental.refresh_orders(Replayed(spark, folder), again, AS_OF).awaitTermination()
    assert rows(store.accepted("orders")) == expected


def test_a_batch_reads_the_buckets_of_its_keys(spark, folder):
    store = incremental.Store(spark, folder)
    assert store.keys("customers") is None
    store.add_keys("customers", spark.range(1000).withColumnRenamed("id", "customer_id"), 0)
    store.add_keys("customers", spark.range(990, 1010).withColumnRenamed("id", "customer_id"), 1)
    keys = store.keys("customers")
    one = spark.createDataFrame([(5,), (5,)], "customer_id long")
    found = incremental._known(one, keys, "customer_id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    bucket = one.select(incremental._bucket(F.col("customer_id"))).first()[0]
    numbers = r"PartitionFilters: \[isnotnull\(bucket#\d+\), \(bucket#\d+ = (\d+)\)\]"
    assert re.findall(numbers, plan) == [str(bucket)]
    assert rows(found) == [(5,)]
    asked = spark.createDataFrame([(995,), (1005,), (2000,), (None,)], "customer_id long")
    assert rows(incremental._known(asked, keys, "customer_id")) == [(1005,), (995,)]
    assert incremental._known(asked.limit(0), keys, "customer_id").count() == 0


def test_refresh_without_new_files_changes_nothing(spark, folder):
    source = sinks.replace(SalesModel(spark, SMALL).bronze["customers"], f"{folder}/in/customers")
    store = incremental.Store(spark, folder)
    for _ in range(2):
        feed = incremental.change_feed(spark, f"{folder}/in/customers", source.schema)
        query = incremental.refresh_customers(store, feed)
        query.awaitTermination()
    assert store.customer_versions().count() == source.count()


def test_freshness(spark, folder):
    source = sinks.replace(spark.range(5), f"{folder}/in")
    feed = incremental.change_feed(spark, f"{folder}/in", source.schema)
    query = incremental.append_to(feed, f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert incremental.freshness(query, now)["status"] == "PASS"
    assert incremental.freshness(query, now + timedelta(days=1))["status"] == "STALE"
    assert spark.read.parquet(f"{folder}/out").count() == 5
