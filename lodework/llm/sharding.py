"""Sharding by Karmarkar-Karp differencing: shards of near equal bytes from indivisible groups.

Documents with equal texts (NULL counts as empty) are a group and stay together. A partial
partition is a list of as many sums as there are shards. Differencing takes the two with
the largest spread and adds them in opposite order, largest to smallest, until one is left.

Up to ``PART`` groups are differenced at once. More are dealt by hash to parts of about that
many, and each part packs its small groups into bundles, which then stay together; groups
larger than a bundle go up as they are, and this is repeated until no more than ``PART``
units are left, which are differenced as if they were groups. A shard takes ``BUNDLES``
bundles, so bundles and larger groups are bounded by the total bytes; those on top fill up
the shards beside a large group, whatever part it came from. A group's shard is found by
following the bundles down.

Rows of a shard are numbered without gaps in the order of (a hash bucket, ``doc_id``): rows
are counted per shard and bucket, and numbered inside a bucket behind those before it, so
a shard that one large group fills is still numbered by many tasks.

Repeated rows and equal ids are rows of their own, a NULL id is a row like others, empty
texts have size 1, and an empty table gives an empty result. Extra columns do not matter.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodework.llm.common import stored

SHARDS = 16
PART = 4096
#: Bundles that make up a shard, the part of what is left that a bundle takes at most, and the part of a bundle that it may always take.
BUNDLES = 64
LAST = 8
LEAST = 64
BUCKET_ROWS = 20_000


def difference(sums: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Combine partial partitions (ascending sums) to one; returns its sums and, per input, the place each sum went to."""
    shards = len(sums[0])
    heap = [(s[0] - s[-1], i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    held, made = list(sums), []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        added = sorted((x + y, k) for k, (x, y) in enumerate(zip(held[a], reversed(held[b]))))
        made.append((a, b, [k for _, k in added]))
        new = [s for s, _ in added]
        heapq.heappush(heap, (new[0] - new[-1], len(held)))
        held[a] = held[b] = None
        held.append(new)
    places: list = [None] * len(held)
    places[-1] = list(range(shards))
    for node in range(len(held) - 1, len(sums) - 1, -1):
        a, b, order = made[node - len(sums)]
        to = [0] * shards
        for place, k in enumerate(order):
            to[k] = places[node][place]
        places[a], places[b], places[node] = to, to[::-1], None
    return held[-1], places[:len(sums)]


def bundle(weights: list[int], size: int) -> list[int]:
    """The bundle of each of the descending ``weights``: none of more than ``size`` but for a weight alone.

    A bundle takes a ``LAST`` part of what is left at most, so the last ones are small and can level out the others.
    """
    left, out, n = sum(w for w in weights if w < size), [], -1
    held = room = 0
    for w in weights:
        if w >= size:
            n += 1
        elif n >= 0 and held and held + w <= room:
            held += w
            left -= w
        else:
            n, held, room = n + 1, w, min(size, max(left // LAST, size // LEAST))
            left -= w
        out.append(n)
    return out


def _sorted(table: pa.Table) -> pa.Table:
    # The order of ties must not depend on that of rows.
    return table.sort_by([("bytes", "descending"), ("id", "ascending")])


def _bundled(dealt: DataFrame, size: int) -> DataFrame:
    """``part, id, bytes`` bundled per part: ``id, up, bytes`` for each id and the bundle's bytes once per bundle ``up``."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table, part = _sorted(table), key[0].as_py()
        weights = table.column("bytes").to_pylist()
        places = bundle(weights, size)
        sums = [0] * (places[-1] + 1)
        for w, k in zip(weights, places):
            sums[k] += w
        first = [i == 0 or places[i - 1] != k for i, k in enumerate(places)]
        return pa.table({"id": table.column("id"), "up": pa.array([(part << 32) + k for k in places], pa.int64()),
                         "bytes": pa.array([sums[k] if f else None for f, k in zip(first, places)], pa.int64())})

    return dealt.groupBy("part").applyInArrow(run, "id long, up long, bytes long")


def _differenced(units: DataFrame, shards: int) -> DataFrame:
    """``id, shard`` of the units ``id, bytes``, differenced at once."""
    def run(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        _, places = difference([[0] * (shards - 1) + [w] for w in table.column("bytes").to_pylist()])
        # A unit is the largest sum of its own partition: the last place.
        return pa.table({"id": table.column("id"), "shard": pa.array([p[-1] for p in places], pa.int32())})

    return units.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(run, "id long, shard int")


def assign(groups: DataFrame, shards: int = SHARDS, part: int = PART) -> DataFrame:
    """``id, shard`` for the rows ``id, bytes`` of ``groups``."""
    part = max(part, 4 * BUNDLES * shards, 1024)  # fewer could be bundles already
    now, maps = groups.select("id", "bytes"), []
    n, total = groups.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    if not n:
        return groups.select("id", F.lit(0).alias("shard"))
    size = max(1, total // (BUNDLES * shards))
    while n > part:
        dealt = now.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(-(-n // part))))
        level = stored(_bundled(dealt, size), f"bundles-{len(maps)}")
        maps.append(level.select("id", "up"))
        now = level.filter(F.col("bytes").isNotNull()).select(F.col("up").alias("id"), "bytes")
        n = now.count()
    found = _differenced(now, shards)
    for level in reversed(maps):
        found = level.join(found.select(F.col("id").alias("up"), "shard"), "up").select("id", "shard")
    return found


def shard(docs: DataFrame, shards: int = SHARDS, part: int = PART, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.md5(text).alias("_text"))
    rows = stored(rows, "sizes")
    groups = rows.groupBy("_text").agg(F.sum("size").alias("bytes"))
    # Ids of groups: their digest stays the key, 64 bits of it only deal and order them.
    groups = stored(groups.select("_text", F.xxhash64("_text").alias("id"), "bytes"), "groups")
    units = groups.groupBy("id").agg(F.sum("bytes").alias("bytes"))
    placed = groups.select("_text", "id").join(assign(units, shards, part), "id").select("_text", "shard")
    buckets = max(1, rows.count() // (shards * bucket_rows))
    dealt = rows.join(placed, "_text").withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "_text"), F.lit(buckets)))
    dealt = stored(dealt, "dealt")
    sizes = dealt.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_before"))
    inside = Window.partitionBy("shard", "_bucket").orderBy("doc_id", "_text")
    numbered = dealt.withColumn("_row", F.row_number().over(inside)).join(sizes, ["shard", "_bucket"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                           (F.col("_before") + F.col("_row") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
