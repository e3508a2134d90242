"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter item is one
window of its own length). Of every window's ``GRAM``-word hashes the least is kept as a
fingerprint, on both sides; so whatever stretch of ``WINDOW`` words a document shares
with an item, both hold the same fingerprint. Documents that share a fingerprint are
read again: every match is extended to the windows around it, and those that equal a
window of an item word by word are hits. Items shorter than a window are found by the
hash of their first words, which documents then give for every position.

Words are ``[0-9a-z]`` and all characters beyond ASCII, A-Z lower-cased. NULL, empty and
wordless texts and items have no windows; a NULL item id counts as the empty string;
repeated rows are judged alike and equal items count once per id; texts of any length
are compared whole; empty tables give no hits; extra columns do not matter.

Only column expressions run here. Fingerprints (about a fifth of the positions, as
64-bit hashes) are all that is exchanged for every document; whether the benchmark's
side is broadcast is left to its measured size. Sets are only collected per document, of
its own positions and of the items it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodework.llm.common import same, stored

WINDOW = 13
GRAM = 5
PERCENT = 5

_KEY = ("_id", "_content")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.filter(F.split(lowered, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), lambda w: w != "")


def _grams(column: str, size: int) -> Column:
    """Hashes of all runs of ``size`` words; empty if there are fewer."""
    n = F.size(column)
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(
        *[F.get(column, i + j) for j in range(size)]))).otherwise(F.array().cast("array<bigint>"))


def _least(column: str) -> Column:
    """The least hash of each window, once."""
    width = WINDOW - GRAM + 1
    return F.when(F.size(column) >= width, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(column) - width + 1), lambda i: F.array_min(F.slice(column, i, width))))
    ).otherwise(F.array().cast("array<bigint>"))


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_content"), words(F.col("text")).alias("_words"), *more)


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            words(F.col("text")).alias("_words")).filter(F.size("_words") > 0)


def _short_lengths(items: DataFrame) -> list[int]:
    """Lengths of items below a window: at most ``WINDOW - 1`` numbers."""
    n = F.size("_words")
    return sorted(r[0] for r in items.filter(n < WINDOW).select(n).distinct().collect())


def _anchors(short: list[int]) -> list[int]:
    """How many first words find the items of the given lengths."""
    return sorted({min(n, GRAM) for n in short})


def _prints(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``size`` and ``hash`` of the winnowed fingerprints of whole windows."""
    hashed = df.select(*keep, _grams("_words", GRAM).alias("_grams"))
    return hashed.select(*keep, F.lit(0).alias("size"), F.explode(_least("_grams")).alias("hash"))


def _all_prints(df: DataFrame, keep: list[str], size: int) -> DataFrame:
    hashed = df.select(*keep, F.array_distinct(_grams("_words", size)).alias("_grams"))
    return hashed.select(*keep, F.lit(size).alias("size"), F.explode("_grams").alias("hash"))


def candidates(docs: DataFrame, benchmark: DataFrame, short: list[int]) -> DataFrame:
    """Per document that shares a fingerprint: the shared hashes by kind (0: of whole windows)."""
    keyed, items = _keyed(docs), _items(benchmark)
    ours, theirs = _prints(keyed, list(_KEY)), _prints(items.filter(F.size("_words") >= WINDOW), [])
    for size in _anchors(short):
        ours = ours.unionByName(_all_prints(keyed, list(_KEY), size))
        first = items.filter((F.size("_words") < WINDOW) & (F.least(F.size("_words"), F.lit(GRAM)) == size))
        theirs = theirs.unionByName(first.select(F.lit(size).alias("size"), F.get(_grams("_words", size), F.lit(0)).alias("hash")))
    shared = ours.join(theirs.distinct(), ["size", "hash"], "left_semi")
    return shared.groupBy(*_KEY).agg(*[
        F.collect_set(F.when(F.col("size") == size, F.col("hash"))).alias(f"_shared{size}") for size in [0, *_anchors(short)]])


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``item``, ``window``: every window of every item, as words joined by blanks, once."""
    n = F.size("_words")
    starts = F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1)))
    listed = _items(benchmark).select("item", F.transform(starts, lambda i: F.array_join(F.slice("_words", i, WINDOW), " ")).alias("_windows"))
    return listed.select("item", F.explode("_windows").alias("window")).distinct()


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document window that equals an item's: key, ``start``, ``length``, ``item``."""
    short = _short_lengths(_items(benchmark))
    found = stored(candidates(docs, benchmark, short), "shared-prints")
    keyed = _keyed(docs)
    read = keyed.join(found, same(keyed, found, _KEY)).drop(*[found[k] for k in _KEY])
    n = F.size("_words")

    def places(size: int) -> Column:
        """Positions of the shared hashes of a kind."""
        length = size or GRAM
        return F.when(n >= length, F.filter(F.sequence(F.lit(0), n - length), lambda i: F.array_contains(
            f"_shared{size}", F.xxhash64(*[F.get("_words", i + j) for j in range(length)])))).otherwise(F.array().cast("array<int>"))

    around = F.array_distinct(F.flatten(F.transform("_places0", lambda p: F.filter(
        F.sequence(p - (WINDOW - GRAM), p), lambda s: (s >= 0) & (s + WINDOW <= n)))))
    placed = read.select(*_KEY, "_words", *[places(size).alias(f"_places{size}") for size in [0, *_anchors(short)]])

    def cut(starts: Column, length: int) -> Column:
        return F.transform(starts, lambda s: F.struct(s.alias("start"), F.lit(length).alias("length"),
                                                      F.array_join(F.slice("_words", s + 1, length), " ").alias("window")))

    kinds = [cut(around, WINDOW)] + [
        cut(F.filter(f"_places{min(length, GRAM)}", lambda s, length=length: s + length <= n), length) for length in short]
    windows = placed.select(*_KEY, F.explode(F.concat(*kinds)).alias("_w")).select(*_KEY, "_w.start", "_w.length", "_w.window")
    return windows.join(item_windows(benchmark), "window").select(*_KEY, "start", "length", "item")


def _summed(found: DataFrame) -> DataFrame:
    """Per document: hit words and the sorted ids of the items."""
    per_doc = found.groupBy(*_KEY).agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("_spans"),
                                       F.sort_array(F.collect_set("item")).alias("items"))
    covered = F.aggregate("_spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")), lambda a, s: F.struct(
        F.greatest(a["end"], s["start"] + s["length"]).alias("end"),
        (a["total"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(a["end"], s["start"]))).alias("total")))
    return per_doc.select(*_KEY, covered["total"].cast("long").alias("n_hit"), "items")


def _judged(docs: DataFrame, benchmark: DataFrame, *more: Column) -> DataFrame:
    keyed = _keyed(docs, *more)
    counted = keyed.select(*[c for c in keyed.columns if c != "_words"], F.size("_words").cast("long").alias("n_words"))
    summed = stored(_summed(hits(docs, benchmark)), "benchmark-hits")
    joined = counted.join(summed, same(counted, summed, _KEY), "left").drop(*[summed[k] for k in _KEY])
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= PERCENT * F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row: ``doc_id``, ``n_words``, ``n_hit``, ``items``, ``contaminated``."""
    return _judged(docs, benchmark).select(F.col("_id").alias("doc_id"), "n_words", "n_hit", F.coalesce(
        "items", F.array().cast("array<string>")).alias("items"), "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are not contaminated."""
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    return _judged(docs, benchmark, row).filter(~F.col("contaminated")).select("_row.*")
