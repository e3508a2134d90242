"""Prefix trie of conversations, built and summed by van Emde Boas recursion.

Every distinct sequence of the first d turns (role, text) is a node. The depths 0 to
2^k - 1 are cut in half again and again: a half of 2^j depths is an upper trie, the half
below it a forest of lower tries, one under each node of the cut.

*Names.* The name of the prefix at a cut is a digest of the name at the start of its half
and of the block of turns in between; both halves go on in parallel from there. A turn is
in one block of each size at most, so a conversation costs one name per turn, without a
shuffle. Blocks are Merkle digests of turn digests (SHA-256, 16 bytes kept). Conversations
longer than ``PIECE`` turns are cut into pieces that are named as if each were one turn,
and so on upwards; a piece is one row, however long its conversation.

*Totals.* From the smallest halves to the largest, the sums of the lower tries' tops are
grafted on the node of the cut and handed to its ancestors in the upper half. A node at a
cut meets each size once, so a trie of depth H takes log2(H) rounds, and a long chain of
turns does not need a round per turn. Members, children and totals are sums that combine
before the shuffle; conversations with the same turns are one row per node from there on.

Rows without ``conv_id`` belong to no conversation and are left out. Turns are ordered by
``turn`` (NULL first) and, where that is equal, by a digest of role and text; repeated rows
are turns of their own. NULL role and text are empty; no text is too long, as only its
digest and its number of words travel. Remainders of negative ids are negative, as in SQL. Extra columns do not matter. An empty table has no
node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodework.functions.ranking import By, numbered
from lodework.llm.common import stored

#: Turns, or pieces of turns, that one row holds; a power of two.
PIECE = 1024
#: Conversation ids of one member list that are joined in one row.
IDS = 1 << 16
#: Conversations that share the opening of one of them, and at most so many turns less one.
FAMILY, OPENING = 20, 4

_BYTES = 16
ROOT = bytes(_BYTES)


def _digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:_BYTES]


def _named(start: bytes, turns: list[bytes]) -> list[bytes]:
    """Names of the prefixes that end behind each of at most ``PIECE`` turns, ``start`` being the name before them."""
    names, blocks = {0: start}, list(turns)
    # blocks[i] is the digest of the block that ends behind turn i and is as long as the lowest bit of i + 1.
    size = 1
    while size < len(turns):
        for end in range(2 * size - 1, len(turns), 2 * size):
            blocks[end] = _digest(blocks[end - size] + blocks[end])
        size *= 2
    # Coarse cuts first: the name at a cut needs the one at the start of its half.
    cuts = range(1, len(turns) + 1)
    for cut in sorted(cuts, key=lambda c: -(c & -c)):
        names[cut] = _digest(names[cut - (cut & -cut)] + blocks[cut - 1])
    return [names[c] for c in cuts]


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def _names(start: pd.Series, turns: pd.Series) -> pd.Series:
    return pd.Series([_named(s, list(t)) for s, t in zip(start, turns)])


@F.pandas_udf(T.BinaryType())
def _whole(turns: pd.Series) -> pd.Series:
    return pd.Series([_named(ROOT, list(t))[-1] for t in turns])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, number from 0, digest, words), numbered over range partitions, so that one conversation may be any size."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        F.substring(F.unhex(F.sha2(told.cast("binary"), 256)), 1, _BYTES).alias("digest"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint").alias("words"))
    # NULL turns come first: they stand before every number.
    keyed = turns.withColumn("known", F.col("turn").isNotNull().cast("int"))
    placed = numbered(keyed, "at", [By("conv_id"), By("known"), By("turn")], ["digest"])
    first = placed.groupBy("conv_id").agg(F.min("at").alias("first"))
    return placed.join(first, "conv_id").select("conv_id", (F.col("at") - F.col("first")).alias("number"), "digest", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations with the opening of their family: turns (conv_id, depth from 1, digest, words), and all ids."""
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))
    asked = F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENING
    head = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = lengths.select("conv_id", head.alias("head"), asked.alias("asked"))
    heads = lengths.select(F.col("conv_id").alias("head"), F.col("length").alias("head_length"))
    known = convs.join(heads, "head", "left").select(
        "conv_id", "head", "asked", F.least(F.col("asked"), F.coalesce("head_length", F.lit(0))).alias("taken"))
    opening = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("number") < OPENING - 1)).withColumnRenamed("conv_id", "head")
    lent = known.filter("taken > 0").join(opening, "head").filter(F.col("number") < F.col("taken")).select(
        "conv_id", (F.col("number") + 1).alias("depth"), "digest", "words")
    own = turns.join(known, "conv_id").filter(F.col("number") >= F.col("asked")).select(
        "conv_id", (F.col("number") - F.col("asked") + F.col("taken") + 1).alias("depth"), "digest", "words")
    return lent.unionByName(own), known.select("conv_id")


def _paths(units: DataFrame) -> DataFrame:
    """(conv_id, depth, name) of the prefixes of sequences given as (conv_id, depth from 1, digest)."""
    piece = F.shiftright(F.col("depth") - 1, PIECE.bit_length() - 1)
    listed = stored(units.groupBy("conv_id", piece.alias("piece")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "digest"))).alias("turns")).select(
        "conv_id", "piece", F.col("turns.digest").alias("turns")), "trie-pieces")
    if listed.agg(F.max("piece")).first()[0]:
        # Only whole pieces have another behind them.
        upper = _paths(listed.filter(F.size("turns") == PIECE).select(
            "conv_id", (F.col("piece") + 1).alias("depth"), _whole("turns").alias("digest")))
        starts = upper.select("conv_id", F.col("depth").alias("piece"), F.col("name").alias("start"))
        listed = listed.join(starts, ["conv_id", "piece"], "left")
    else:
        listed = listed.withColumn("start", F.lit(None).cast("binary"))
    named = listed.select("conv_id", "piece", _names(F.coalesce("start", F.lit(bytearray(ROOT))), "turns").alias("names"))
    return named.select("conv_id", "piece", F.posexplode("names").alias("i", "name")).select(
        "conv_id", (F.col("piece") * PIECE + F.col("i") + 1).alias("depth"), "name")


def paths(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, depth, name, parent) of every prefix of every conversation, the root's included."""
    # The root is the name behind no turn; its depth is 0 and nothing is its parent.
    named = _paths(turns.select("conv_id", "depth", "digest"))
    roots = ids.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(bytearray(ROOT)).alias("name"))
    return named.unionByName(roots)


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    turns, ids = rebuilt(ordered_turns(conversations))
    turns = stored(turns, "trie-rebuilt")
    ids = stored(ids, "trie-ids")
    walked = stored(paths(turns, ids), "trie-paths")
    nodes = stored(_nodes(walked, turns), "trie-nodes")
    totals = _totals(nodes, walked)
    ends = _ends(walked)
    named = nodes.join(totals, "name").join(ends, "name", "left")
    return named.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def _nodes(walked: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per name: its smallest member, depth, members, children, parent and that one's smallest member, words."""
    counted = walked.groupBy("name").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
                                         F.count(F.lit(1)).alias("n_convs"))
    # The smallest member's own path leads to the parent, its own turn tells the words.
    over = walked.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    last = turns.select("conv_id", "depth", "words")
    known = stored(counted.join(over, ["conv_id", "depth"], "left").join(last, ["conv_id", "depth"], "left"), "trie-counted")
    children = known.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("name")).agg(
        F.count(F.lit(1)).alias("n_children"))
    parents = known.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return known.join(children, "name", "left").join(parents, "parent", "left").select(
        "name", "conv_id", "depth", "parent", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), F.coalesce("words", F.lit(0)).alias("words"))


def _totals(nodes: DataFrame, walked: DataFrame) -> DataFrame:
    """(name, n_leaves, saved_tokens) over subtrees, grafted upwards half by half."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = {"n_leaves": (F.col("n_children") == 0).cast("bigint"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}
    told = ["name", "conv_id", "depth", "parent", "parent_conv_id"]
    state = nodes.select(*told, *[c.alias(n) for n, c in sums.items()])
    for level in range(deepest.bit_length()):
        # Tops of the lower tries: the first depth of an odd half of 2^level depths.
        below = F.col("depth") % (2 << level) == (1 << level)
        grafts = state.filter(below).groupBy("parent", F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("cut")).agg(
            *[F.sum(n).alias(n) for n in sums])
        # The cut's ancestors in the upper half lie on the path of its smallest member.
        half = F.shiftright("depth", level)
        upper = walked.filter(half % 2 == 0).select("conv_id", "name", half.alias("half"))
        handed = grafts.withColumn("half", F.shiftright("cut", level)).join(upper, ["conv_id", "half"]).groupBy("name").agg(
            *[F.sum(n).alias(n) for n in sums])
        added = handed.select("name", *[F.col(n).alias(f"_{n}") for n in sums])
        state = stored(state.join(added, "name", "left").select(
            *told, *[(F.col(n) + F.coalesce(F.col(f"_{n}"), F.lit(0))).alias(n) for n in sums]), "trie-totals")
    return state.select("name", *sums)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest per name of its id lists, which come sorted by name and first id; one list is held at a time."""
    name, hasher = None, None
    for batch in batches:
        names, digests = [], []
        for key, ids in zip(batch.column("name").to_pylist(), batch.column("ids")):
            if key != name:
                if hasher is not None:
                    names.append(name)
                    digests.append(hasher.hexdigest())
                name, hasher = key, hashlib.sha256()
            else:
                hasher.update(b",")
            hasher.update(ids.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], names=["name", "ends_sha256"])
    if hasher is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([hasher.hexdigest()])], names=["name", "ends_sha256"])


def _ends(walked: DataFrame) -> DataFrame:
    """(name, ends_sha256) of the nodes at which conversations end.

    Ids are joined in lists of at most ``IDS``, which combine by range of ids in many tasks;
    a digest of them all is sequential by nature, and streams one node's lists.
    """
    ended = walked.groupBy("conv_id").agg(F.max_by("name", "depth").alias("name"))
    span = F.shiftright("conv_id", IDS.bit_length() - 1).alias("span")
    lists = ended.groupBy("name", span).agg(F.sort_array(F.collect_list("conv_id")).alias("ids")).select(
        "name", "span", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    streamed = lists.repartition("name").sortWithinPartitions("name", "span").select("name", "ids")
    return streamed.mapInArrow(_hashed, "name binary, ends_sha256 string")
