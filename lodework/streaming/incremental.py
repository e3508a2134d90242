"""Incremental silver: bronze change feeds, latest customers, orders and lines that wait for their parent.

A refresh processes the files that arrived since the last one (``availableNow``) or runs on
a five-minute trigger. Every micro-batch writes a folder named after its batch id, so a
batch that is repeated after a failure replaces its own output. Writes grow with the batch,
not with the table:

* customers append the batch's latest row per key; readers take the latest over all batches,
  and ``compact`` folds old batches together;
* orders and lines are joined to the known parent keys. Rows with a parent are accepted, the
  others wait where they were written; no later batch touches them. When parents have come,
  ``settle`` marks their keys as settled, once for all rows that waited for them;
  ``refresh_all`` does so down the chain, so the order in which tables arrive does not matter.

Parent keys are kept apart from the rows, in ``BUCKETS`` folders by their hash. A batch reads
the folders of the keys that it asks for and no others, and what it shuffles of them are those
keys. Keys and marks are only ever asked whether they hold a key, so one that a repeated batch
or a repeated ``settle`` writes twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lodework.operators import silver
from lodework.operators.sinks import stored_rows

EVERY = "5 minutes"
#: Folders that the keys of a parent table are spread over.
BUCKETS = 64
# Per child its parent table and the column that refers to it, and per parent that is a child itself its key.
PARENT = {"orders": ("customers", "customer_id"), "order_items": ("orders", "order_id")}
KEY = {"orders": "order_id"}


def change_feed(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder as a stream; the checkpoint of the reader is its position."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def append_to(feed: DataFrame, folder: str, checkpoint: str, *, continuous: bool = False) -> StreamingQuery:
    """Append a feed to a bronze folder exactly once."""
    return _started(feed.writeStream.format("parquet").option("path", folder)
                    .option("checkpointLocation", checkpoint), continuous)


def _started(writer, continuous: bool) -> StreamingQuery:
    trigger = {"processingTime": EVERY} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def _write_batch(df: DataFrame, folder: str, batch_id: int, *partitions: str) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(f"{folder}/batch={batch_id}")


@dataclass(frozen=True)
class Store:
    """Folders of the incremental tables below one root."""

    spark: SparkSession
    root: str

    def folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    # --- customers
    def customer_versions(self) -> DataFrame | None:
        base = stored_rows(self.spark, self.folder("customers"))
        return base.drop("batch") if base is not None else None

    def customers(self) -> DataFrame:
        """Latest row per customer over all batches."""
        return silver.latest_per_key(self.customer_versions(), "customer_id").drop("_loaded_at")

    def keys(self, parent: str) -> DataFrame | None:
        """Keys that children may refer to, with their bucket; None before there are any."""
        return stored_rows(self.spark, self.folder(f"{parent}_keys"))

    # --- children
    def accepted(self, name: str) -> DataFrame | None:
        """Rows whose parent is known: at their batch or settled since; None before the first batch."""
        rows = stored_rows(self.spark, self.folder(name))
        if rows is None:
            return None
        at_once = rows.filter(F.col("accepted") == 1).drop("accepted", "batch")
        settled = self.settled(name)
        if settled is None:
            return at_once
        late = self._waiting(rows).join(settled, PARENT[name][1], "left_semi").select(*at_once.columns)
        return at_once.unionByName(late)

    def settled(self, name: str) -> DataFrame | None:
        """Parent keys that came after rows which waited for them."""
        marks = stored_rows(self.spark, self.folder(f"{name}_settled"))
        return marks if marks is None else marks.select(PARENT[name][1])

    def waiting(self, name: str) -> DataFrame | None:
        """Rows still without a parent; None before the first batch."""
        rows = stored_rows(self.spark, self.folder(name))
        if rows is None:
            return None
        left, settled = self._waiting(rows), self.settled(name)
        return left if settled is None else left.join(settled, PARENT[name][1], "left_anti").select(*left.columns)

    @staticmethod
    def _waiting(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("accepted") == 0).drop("accepted", "batch")

    def add_keys(self, parent: str, keys: DataFrame, batch_id: int | None) -> None:
        """Keys of a batch, in place of those it wrote before; without a batch they are added."""
        dealt = keys.distinct().withColumn("bucket", _bucket(F.col(keys.columns[0]))).hint("rebalance", "bucket")
        if batch_id is None:
            dealt.write.mode("append").partitionBy("bucket").parquet(f"{self.folder(f'{parent}_keys')}/batch=-1")
        else:
            _write_batch(dealt, self.folder(f"{parent}_keys"), batch_id, "bucket")


def refresh_customers(store: Store, feed: DataFrame, *, continuous: bool = False) -> StreamingQuery:
    """Keep the latest row per customer."""

    def write(batch: DataFrame, batch_id: int) -> None:
        known = batch.filter(F.col("customer_id").isNotNull())
        clean = silver.latest_per_key(known, "customer_id").withColumn(
            "segment", F.upper(F.trim("segment"))).drop("_source_table", "_row_number")
        _write_batch(clean, store.folder("customers"), batch_id)
        store.add_keys("customers", known.select("customer_id"), batch_id)

    return _run(feed, write, store.folder("checkpoints/customers"), continuous)


def _bucket(key: Column) -> Column:
    return F.pmod(F.hash(key), F.lit(BUCKETS))


def _known(rows: DataFrame, parents: DataFrame | None, key: str) -> DataFrame:
    """Those parent keys that ``rows`` refer to, once each; none if no parent is stored yet."""
    asked = rows.select(key).distinct()
    if parents is None:
        return asked.limit(0)
    # At most BUCKETS numbers, which name the folders to be read.
    touched = [r[0] for r in rows.select(_bucket(F.col(key))).distinct().collect()]
    held = parents.filter(F.col("bucket").isin(touched)) if touched else parents.limit(0)
    return held.select(key).join(asked, key, "left_semi").distinct()


def refresh_children(store: Store, name: str, feed: DataFrame, clean: Callable[[DataFrame], DataFrame],
                     *, continuous: bool = False) -> StreamingQuery:
    """Accept rows whose parent is known, let the others wait."""
    parent, key = PARENT[name]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = clean(batch).drop("_loaded_at", "_source_table", "_row_number")
        parents = _known(rows, store.keys(parent), key).withColumn("_known", F.lit(True))
        decided = rows.join(parents, key, "left").withColumn(
            "accepted", F.when(F.col("_known"), 1).otherwise(0)).drop("_known")
        _write_batch(decided, store.folder(name), batch_id, "accepted")
        if name in KEY:
            written = store.spark.read.schema(decided.schema).parquet(f"{store.folder(name)}/batch={batch_id}")
            store.add_keys(name, written.filter(F.col("accepted") == 1).select(KEY[name]), batch_id)

    return _run(feed, write, store.folder(f"checkpoints/{name}"), continuous)


def settle(store: Store, name: str) -> None:
    """Accept the waiting rows whose parent has arrived since their batch; call it between refreshes."""
    (parent, key), waiting = PARENT[name], store.waiting(name)
    if waiting is None:
        return
    arrived = _known(waiting, store.keys(parent), key)
    if name in KEY:
        # Before the marks: a run that ends between the two is made good by the next, which still finds the rows waiting.
        store.add_keys(name, waiting.join(arrived, key, "left_semi").select(KEY[name]), None)
    arrived.write.mode("append").parquet(store.folder(f"{name}_settled"))


def refresh_orders(store: Store, feed: DataFrame, as_of: date, **options) -> StreamingQuery:
    return refresh_children(store, "orders", feed, lambda rows: silver.valid_orders(rows, as_of), **options)


def refresh_order_items(store: Store, feed: DataFrame, **options) -> StreamingQuery:
    """Lines follow their order; the product is not checked here."""
    return refresh_children(store, "order_items", feed, silver.valid_items, **options)


def _run(feed: DataFrame, write, checkpoint: str, continuous: bool) -> StreamingQuery:
    return _started(feed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), continuous)


def refresh_all(store: Store, feeds: dict[str, DataFrame], as_of: date) -> None:
    """One refresh in dependency order: customers, then orders, then lines; waiting rows are settled on the way."""
    refresh_customers(store, feeds["customers"]).awaitTermination()
    refresh_orders(store, feeds["orders"], as_of).awaitTermination()
    settle(store, "orders")
    refresh_order_items(store, feeds["order_items"]).awaitTermination()
    settle(store, "order_items")


def compact_customers(store: Store, target: str) -> DataFrame:
    """Fold all customer batches into one latest-per-key table."""
    silver.latest_per_key(store.customer_versions(), "customer_id").write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(target)
    return store.spark.read.parquet(target)


def freshness(query: StreamingQuery, now: datetime, lag_limit_minutes: int = 5) -> dict[str, object]:
    """Lag of a query behind the clock, from its last progress report."""
    progress = query.lastProgress
    if progress is None:
        return {"name": query.name, "lag_seconds": None, "status": "NO DATA"}
    at = datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")).replace(tzinfo=None)
    lag = (now - at).total_seconds()
    return {"name": query.name, "lag_seconds": lag, "input_rows": progress["numInputRows"],
            "status": "PASS" if lag <= lag_limit_minutes * 60 else "STALE"}
