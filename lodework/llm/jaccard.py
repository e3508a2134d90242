"""Similarity join on word shingles by chosen paths, and the groups that its links make.

Texts with the same shingle set are one *kind*. In every run a kind walks down a path: at
each level a token is sampled from its set by a minwise hash of that run and level, and
kinds that chose the same token stay together - with a probability equal to their Jaccard
similarity. A bucket of at most ``SMALL`` kinds is compared by brute force; a larger one
is split by the next level, down to ``LEVELS``. What is larger even there is mostly one
passage's near copies. They are packed into *balls*: the kinds whose exact distance from
a representative is at most half of the distance that links. Jaccard distance is a metric,
so all kinds of a ball are linked, and their links are counted from the ball's size. What
remains of a large bucket is compared in blocks, all pairs but those inside a ball, with
nothing left out. Runs are repeated until a pair at the threshold, on the deepest path, is
found with the target recall.

A pair belongs to the first run that brings it together, so it counts once. Pairs are
first weighed by the minwise hashes and, if they may reach the threshold, compared by
their exact shingle sets. No pair leaves its task: a block returns each kind's number of
links and one edge to the kinds it was joined with, so results grow with the documents
and not with the squares of groups.

Texts without words (and NULL) are alone. Repeated rows and equal ids count as documents
of their own; a NULL id can be in a group but does not name it. An empty table gives an
empty result; long texts are compared whole; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodework.llm.common import same, stored
from lodework.llm.shingles import mix, sets

SIMILARITY = 0.8
RECALL = 0.995
LEVELS = 4
SMALL = 64
BLOCK = 400
#: Pairs whose minwise estimate is this far below the threshold are not compared exactly (five standard deviations).
SLACK = 0.3
_STEP = 1 << 21
#: Parts over which the rows of one key are spread in joins with a table of few rows a bucket or ball.
SPREAD = 64


def runs(similarity: float = SIMILARITY, recall: float = RECALL, levels: int = LEVELS) -> int:
    """Runs after which a pair at the threshold has met with the given probability, on a path of full depth."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity ** levels)))


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    ends = np.cumsum([len(x) if x else 0 for x in texts.cast(pa.large_binary()).to_pylist()], dtype=np.int64) if len(texts) else []
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _STEP, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def _kind(text: Column, hashes: int) -> Column:
    """``struct<kind, path>``: digest of the shingle set, and its minwise hashes; both NULL without words."""
    seeds = np.random.default_rng(5).integers(1, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in _slices(texts):
                tokens, bounds = sets(part)
                some = np.flatnonzero(np.diff(bounds))
                least = np.empty((len(part), hashes), np.int64)
                for k, seed in enumerate(seeds):
                    if len(some):
                        least[some, k] = np.minimum.reduceat(mix(tokens * seed), bounds[some]).view(np.int64)
                listed, empty = tokens.tobytes(), np.diff(bounds) == 0
                digests = [None if a == b else hashlib.md5(listed[8 * a:8 * b]).digest()
                           for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                least[empty] = 0
                path = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * hashes, pa.int32()), pa.array(least.ravel()))
                yield pa.StructArray.from_arrays([pa.array(digests, pa.binary()), path], names=["kind", "path"])

    return F.arrow_udf(run, "kind binary, path array<bigint>")(text)


def _tokens(text: Column) -> Column:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in _slices(texts):
                tokens, bounds = sets(part)
                yield pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tokens.view(np.int64)))

    return F.arrow_udf(run, "array<bigint>")(text)


def _buckets(kinds: DataFrame, n_runs: int, levels: int, small: int) -> DataFrame:
    """``kind, run, bucket, n``: the bucket of each kind in each run where it meets others, and the bucket's size."""
    spread = kinds.select("kind", F.explode(F.transform(F.sequence(F.lit(0), F.lit(n_runs - 1)), lambda r: F.struct(
        r.alias("run"), *[F.xxhash64(r, F.slice("path", r * levels + 1, d)).alias(f"k{d}") for d in range(1, levels + 1)]
    ))).alias("_s")).select("kind", "_s.*")
    ended, left = [], spread
    for d in range(1, levels + 1):
        sizes = left.groupBy("run", f"k{d}").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        met = left.join(sizes, ["run", f"k{d}"])
        if d < levels:
            met = stored(met, f"paths-{d}")
            ended.append(met.filter(F.col("n") <= small).select("kind", "run", F.col(f"k{d}").alias("bucket"), "n"))
            left = met.filter(F.col("n") > small).drop("n")
        else:
            ended.append(met.select("kind", "run", F.col(f"k{d}").alias("bucket"), "n"))
    every = ended[0]
    for more in ended[1:]:
        every = every.unionByName(more)
    return every


def _spread_join(rows: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """Join on ``keys`` where ``few`` has one row a key: its rows are repeated, so that a hot key lies in many tasks."""
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64("kind"), F.lit(SPREAD)))
    copied = few.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    return dealt.join(copied, [*keys, "_part"]).drop("_part")


def _sets(docs: DataFrame, kinds: DataFrame, wanted: DataFrame) -> DataFrame:
    """``kind, tokens`` of the wanted kinds, read from the text of the first document of each."""
    texts = stored(wanted.join(kinds.select("kind", "_first.*"), "kind"), "wanted-kinds")
    source = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_content"), "text")
    # A merge join at every size: the side of the texts grows with the documents, that of the keys with the links.
    read = source.join(texts.hint("merge"), same(source, texts, ["_id", "_content"])).select("kind", _tokens(F.col("text")).alias("tokens"))
    return read.dropDuplicates(["kind"])


def _asked(buckets: DataFrame, block: int) -> DataFrame:
    """``kind, head`` of every kind of a large bucket: the least kind that it met in one."""
    large = buckets.filter(F.col("n") > block).select("kind", "run", "bucket")
    heads = large.groupBy("run", "bucket").agg(F.min("kind").alias("head"))
    return _spread_join(large, heads, ["run", "bucket"]).groupBy("kind").agg(F.min("head").alias("head"))


def _balls(asked: DataFrame, sets: DataFrame, kinds: DataFrame, similarity: float, block: int) -> DataFrame:
    """``kind, ball, others, least`` of the kinds in balls: the ball, its other documents, and its least kind.

    A kind is in the ball of the head it asked for if it is near enough by the exact sets. A
    ball of fewer kinds than a block is given up.
    """
    centres = sets.join(asked.select(F.col("head").alias("kind")).distinct(), "kind").select(
        F.col("kind").alias("head"), F.col("tokens").alias("_centre"))
    shared = F.size(F.array_intersect("tokens", "_centre"))
    union = F.size("tokens") + F.size("_centre") - shared
    # Half the distance that links; room for the last bit only, as where pairs are compared.
    inside = _spread_join(asked.join(sets, "kind"), centres, ["head"]).filter(
        shared >= F.lit((1 + similarity) / 2) * union - 1e-9).select("kind", "head")
    inside = stored(inside.join(kinds.select("kind", "copies"), "kind"), "near-heads")
    totals = inside.groupBy("head").agg(F.count(F.lit(1)).alias("_kinds"), F.sum("copies").alias("_all"), F.min("kind").alias("least"))
    return _spread_join(inside, totals.filter(F.col("_kinds") >= block), ["head"]).select(
        "kind", F.xxhash64("head").alias("ball"), (F.col("_all") - F.col("copies")).alias("others"), "least")


def _small(buckets: DataFrame, block: int) -> DataFrame:
    """Rows of the buckets that are one block."""
    return buckets.filter(F.col("n") <= block).select(
        "kind", "run", "bucket", F.lit(0).alias("block_a"), F.lit(0).alias("block_b"), F.lit(True).alias("low"))


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """Rows of large buckets (with their ``ball``, 0 for none) dealt to the pairs of blocks of their bucket.

    The kinds of a ball have blocks of their own, which are not paired with each other; a
    ball with less than a block in a bucket counts as none there. ``low`` tells which block
    the row is of.
    """
    large = members.filter(F.col("n") > block).select("kind", "run", "bucket", "ball")
    here = large.groupBy("run", "bucket", "ball").agg(F.count(F.lit(1)).alias("_m"))
    # One row a ball and bucket: a window holds as many rows as a bucket has balls.
    bucket = Window.partitionBy("run", "bucket")
    before = bucket.orderBy("ball").rowsBetween(Window.unboundedPreceding, -1)
    packed = (F.col("ball") != 0) & (F.col("_m") >= block)
    here = here.withColumn("_packed", packed).withColumn("_own", F.when(packed, F.ceil(F.col("_m") / block)).otherwise(0)).select(
        "run", "bucket", "ball", "_packed", "_own",
        F.ceil(F.sum(F.when(packed, 0).otherwise(F.col("_m"))).over(bucket) / block).alias("_free"),
        F.coalesce(F.sum("_own").over(before), F.lit(0)).alias("_before"), F.sum("_own").over(bucket).alias("_balls"))
    here = here.select(
        "run", "bucket", "ball", "_packed", (F.col("_free") + F.col("_balls")).cast("int").alias("_n"),
        F.when(F.col("_packed"), F.col("_free") + F.col("_before")).otherwise(0).cast("int").alias("_first"),
        F.when(F.col("_packed"), F.col("_own")).otherwise(F.col("_free")).cast("int").alias("_blocks"))
    every = F.sequence(F.lit(0), F.col("_n") - 1)
    others = F.when(F.col("_packed"), F.filter(every, lambda k: (k < F.col("_first")) | (k >= F.col("_first") + F.col("_blocks")))).otherwise(every)
    dealt = _spread_join(large, here, ["run", "bucket", "ball"]).withColumn(
        "_mine", F.col("_first") + F.pmod(F.xxhash64("kind"), F.col("_blocks")).cast("int")).withColumn("_other", F.explode(others))
    return dealt.select(
        "kind", "run", "bucket", F.least("_mine", "_other").alias("block_a"), F.greatest("_mine", "_other").alias("block_b"),
        (F.col("_mine") <= F.col("_other")).alias("low"))


_GROUP = ["run", "bucket", "block_a", "block_b"]


def _by_group(frame: DataFrame, work: Callable[[pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """``work`` on the rows of each pair of blocks (at most two blocks), whose keys are dealt out and sorted by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def groups(table: pa.Table, last: bool):
            keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in _GROUP], 1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            starts = [0, *edges.tolist(), len(keys)]
            n = len(starts) - 1 if last else len(starts) - 2
            found = [x for x in (work(table.slice(a, b - a)) for a, b in zip(starts[:n], starts[1:n + 1])) if x is not None]
            return found, None if last else table.slice(starts[-2])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            found, held = groups(held.combine_chunks(), False)
            for x in found:
                yield from x.to_batches()
        if held is not None:
            for x in groups(held.combine_chunks(), True)[0]:
                yield from x.to_batches()

    return frame.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(run, schema)


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def _new_pairs(table: pa.Table, similarity: float) -> np.ndarray:
    """Which pairs of rows (i < j), not of one ball, may reach the similarity and meet in this run for the first time."""
    n, run = table.num_rows, table.column("run")[0].as_py()
    path, met = _matrix(table, "path"), _matrix(table, "buckets")
    low, ball = table.column("low").to_numpy(), table.column("ball").to_numpy()
    across = table.column("block_a")[0].as_py() != table.column("block_b")[0].as_py()
    pairs = np.zeros((n, n), bool)
    for i in range(n - 1):
        able = (path[i + 1:] == path[i]).mean(1) >= similarity - SLACK
        able &= ~((met[i + 1:, :run] == met[i, :run]) & (met[i, :run] != 0)).any(1)
        if ball[i]:
            able &= ball[i + 1:] != ball[i]
        if across:
            able &= low[i + 1:] != low[i]
        pairs[i, i + 1:] = able
    return pairs


def _candidates(table: pa.Table, similarity: float) -> pa.Table | None:
    pairs = _new_pairs(table, similarity)
    some = pairs.any(0) | pairs.any(1)
    return table.filter(pa.array(some)).select(["kind", *_GROUP, "low"]) if some.any() else None


def _links(table: pa.Table, similarity: float) -> pa.Table | None:
    """Exact comparison: number of linked documents of each row, and an edge to the first row it is joined with."""
    pairs = _new_pairs(table, similarity)
    column = table.column("tokens").combine_chunks()
    values, bounds = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
    _, ids = np.unique(values, return_inverse=True)
    sizes, weight = np.diff(bounds), table.column("copies").to_numpy()
    marks = np.zeros(int(ids.max()) + 1, np.int32)
    links, root = np.zeros(len(sizes), np.int64), np.arange(len(sizes))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = int(root[i])
        return i

    for i in np.flatnonzero(pairs.any(1)).tolist():
        mine = ids[bounds[i]:bounds[i + 1]]
        marks[mine] = 1
        other = np.flatnonzero(pairs[i])
        first, last = int(other[0]), int(other[-1]) + 1
        shared = np.add.reduceat(marks[ids[bounds[first]:bounds[last]]], bounds[first:last] - bounds[first])[other - first]
        marks[mine] = 0
        # shared / (a + b - shared) >= similarity, with a little room for the last bit only
        linked = other[shared >= similarity * (sizes[i] + sizes[other] - shared) - 1e-9]
        links[i] += weight[linked].sum()
        links[linked] += weight[i]
        for j in linked.tolist():
            a, b = top(i), top(j)
            root[max(a, b)] = min(a, b)
    some = np.flatnonzero(links)
    if len(some) == 0:
        return None
    kind = table.column("kind").combine_chunks()
    return pa.table({"kind": kind.take(pa.array(some)), "links": pa.array(links[some]),
                     "to": kind.take(pa.array([top(int(i)) for i in some]))})


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node of the ``(a, b)`` edges: the least node of its component.

    Large-star and small-star steps in turn: every node is hung below the least neighbour,
    until nothing changes, which takes about as many rounds as the logarithm of the nodes.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    while True:
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        changed = new.join(now, ["a", "b"], "left_anti").limit(1).count()
        now = new
        if not changed:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select("b", "b").distinct())


def linked(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, levels: int = LEVELS,
           small: int = SMALL, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their kind, kinds with their number of links, edges between linked kinds)."""
    n_runs = runs(similarity, recall, levels)
    told = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_content"),
                       _kind(F.col("text"), n_runs * levels).alias("_k")).select("_id", "_content", "_k.*")
    told = stored(told, "kinds-of-documents")
    kinds = stored(told.filter(F.col("kind").isNotNull()).groupBy("kind").agg(
        F.min(F.struct("_id", "_content")).alias("_first"), F.count(F.lit(1)).alias("copies"),
        F.first("path").alias("path")), "kinds")
    buckets = stored(_buckets(kinds, n_runs, levels, small), "buckets")
    met = buckets.groupBy("kind").agg(F.map_from_entries(F.collect_list(F.struct("run", "bucket"))).alias("_met"))
    met = met.select("kind", F.transform(F.sequence(F.lit(0), F.lit(n_runs - 1)), lambda r: F.coalesce(
        F.try_element_at("_met", r), F.lit(0).cast("long"))).alias("buckets"))
    shown = met.join(kinds.select("kind", "path", "copies"), "kind")
    asked = stored(_asked(buckets, block), "asked")

    def candidates(dealt: DataFrame, known: DataFrame) -> DataFrame:
        return _by_group(dealt.join(known, "kind"), lambda t: _candidates(t, similarity),
                         "kind binary, run int, bucket long, block_a int, block_b int, low boolean")

    able = stored(candidates(_small(buckets, block), shown.withColumn("ball", F.lit(0).cast("long"))), "able")
    # The texts move once: for these, and for all kinds of large buckets.
    sets = stored(_sets(docs, kinds, able.select("kind").union(asked.select("kind")).distinct()), "able-sets")
    balls = stored(_balls(asked, sets, kinds, similarity, block), "balls")
    ball = F.coalesce("ball", F.lit(0).cast("long")).alias("ball")
    shown = shown.join(balls.select("kind", "ball"), "kind", "left").select("kind", "path", "copies", "buckets", ball)
    dealt = _blocks(buckets.join(balls.select("kind", "ball"), "kind", "left").select("kind", "run", "bucket", "n", ball), block)
    able = able.unionByName(stored(candidates(dealt, shown), "able-in-blocks"))
    found = stored(_by_group(able.join(shown, "kind").join(sets, "kind"), lambda t: _links(t, similarity),
                             "kind binary, links long, to binary"), "links")
    found = found.union(balls.select("kind", "others", "least"))
    numbers = found.groupBy("kind").agg(F.sum("links").alias("links"))
    return told, kinds.select("kind", "copies").join(numbers, "kind", "left"), found.select(
        F.col("kind").alias("a"), F.col("to").alias("b"))


def _labelled(docs: DataFrame, **options) -> DataFrame:
    """Keys of the document rows, the label of their group (NULL without words), and ``n_links``."""
    told, kinds, edges = linked(docs, **options)
    named = kinds.join(components(edges).withColumnRenamed("node", "kind"), "kind", "left").select(
        "kind", F.coalesce("label", "kind").alias("label"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0).cast("long"))).alias("n_links"))
    return stored(told.select("_id", "_content", "kind").join(named, "kind", "left").drop("kind"), "labelled")


def join(docs: DataFrame, **options) -> DataFrame:
    """One row per document row: ``doc_id``, ``class_id``, ``n_links``.

    ``class_id`` is the least id of the documents that links and equal sets connect;
    ``n_links`` counts the other documents at or above the similarity, copies included.
    """
    owned = _labelled(docs, **options)
    least = owned.filter(F.col("label").isNotNull()).groupBy("label").agg(F.min("_id").alias("class_id"))
    return owned.join(least, "label", "left").select(
        F.col("_id").alias("doc_id"), F.coalesce("class_id", "_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def clean(docs: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns: of each group the one of the least id.

    Of rows equal in id and text, that whose other columns come first as JSON stays.
    """
    owned = _labelled(docs, **options)
    grouped = owned.filter(F.col("label").isNotNull()).groupBy("label").agg(
        F.min(F.struct(F.col("_id").isNull().alias("_null"), "_id", "_content")).alias("_k"))
    kept = stored(grouped.select("_k._id", "_k._content").union(
        owned.filter(F.col("label").isNull()).select("_id", "_content").distinct()), "kept")
    keyed = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_content"),
                        F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    found = keyed.join(kept, same(keyed, kept, ["_id", "_content"])).select(keyed["_id"], keyed["_content"], "_row")
    others = F.to_json(F.struct(F.lit(0).alias("_none"), *[F.col(f"_row.`{c}`") for c in docs.columns if c != "text"]))
    return found.groupBy("_id", "_content").agg(F.min_by("_row", others).alias("_row")).select("_row.*")
