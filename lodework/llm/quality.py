"""Quality rules: word and line counts of a document, and lines that many documents of a host repeat.

A host's line is *frequent* when more than ``max_documents`` distinct documents of the
host hold it (compared in lower case, with white space collapsed); exact copies of a text
are one document. Frequent lines are removed; a document that keeps less than ``min_left``
percent of its line characters is depleted and rejected.

Every row is judged: NULL and empty texts have no words and fail the base rules; a NULL
host is a host of its own; repeated rows and repeated ids are kept and judged alike; an
empty table gives an empty result; extra columns do not matter.

Only column expressions run here. The three-word windows of a document are hashed,
sorted and compared inside its row, so nothing of them is shuffled. The lines are split and
hashed once, into a table of 16-byte hashes; the distinct documents of a line are dealt by
line and document, so a line that every document holds is no hot key, and frequent lines
meet their documents in ``SALTS`` parts each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodework.llm.common import SPACE, same, stored, words

MAX_DOCUMENTS = 20
MIN_LEFT = 30
#: Parts in which the documents of one frequent line are looked up.
SALTS = 16

_KEY = ("_id", "_content")
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _keyed(docs: DataFrame, *more) -> DataFrame:
    return docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text", "source").alias("_content"),
                       # A NULL host is told from an empty one.
                       F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_host"), F.coalesce("text", F.lit("")).alias("_text"), *more)


def _collapsed(line):
    return F.trim(F.regexp_replace(line, SPACE, " "))


def base_counts(keyed: DataFrame) -> DataFrame:
    """``keyed`` with the base counts, ``base_failed`` and ``_chars`` (characters in lines), without the text."""
    rest = [c for c in keyed.columns if c != "_text"]
    split = keyed.select(*rest, "_text", words(F.col("_text")).alias("_words"),
                         F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_lines"))
    hashed = split.select(
        *rest, F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(F.transform("_lines", lambda x: F.length(_collapsed(x)).cast("long")),
                    F.lit(0).cast("long"), lambda total, n: total + n).alias("_chars"),
        F.when(F.size("_words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("_words") - 3),
            lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))).alias("_grams"))
    rest = [c for c in hashed.columns if c != "_grams"]
    # Windows sorted by hash: a window that equals a neighbour occurs twice or more.
    placed = hashed.select(*rest, F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), F.sort_array(
        F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_placed"))
    starts = placed.select(*rest, F.sort_array(F.transform(
        F.filter("_placed", lambda s, j: s["h"].eqNullSafe(F.get("_placed", j - 1)["h"])
                 | s["h"].eqNullSafe(F.get("_placed", j + 1)["h"])), lambda s: s["i"])).alias("_starts"))
    new_words = F.transform("_starts", lambda p, j: F.least(F.lit(3), F.coalesce(p - F.get("_starts", j - 1), F.lit(3))))
    counted = starts.select(*rest, F.coalesce(F.aggregate(new_words, F.lit(0), lambda total, n: total + n), F.lit(0))
                            .cast("long").alias("n_repeat_words"))
    return counted.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word: key, host, line number, hash, characters."""
    # White space other than line feeds is collapsed once per text; what is left at a line's ends is one blank.
    spaced = F.regexp_replace("_text", "[\\x20\\x09\\x0B-\\x0D]+", " ")
    listed = _keyed(docs).select(*_KEY, "_host", F.transform(F.split(spaced, "\n"), lambda x: F.trim(x)).alias("_lines"))
    flat = listed.select(*_KEY, "_host", F.posexplode("_lines").alias("number", "_line")).filter(F.col("_line") != "")
    return flat.select(*_KEY, "_host", "number", F.unhex(F.md5(F.lower("_line"))).alias("hash"),
                       F.length("_line").cast("long").alias("chars"))


def frequent_lines(seen: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """``(_host, hash, n_documents)`` of the ``lines`` that more than ``max_documents`` distinct texts of the host hold."""
    once = seen.groupBy("_host", "hash", "_content").agg(F.lit(1).alias("_one"))
    return once.groupBy("_host", "hash").agg(F.count("_one").alias("n_documents")).filter(F.col("n_documents") > max_documents)


def removed_lines(docs: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """Per document with a frequent line: the numbers of the removed lines and their characters."""
    seen = stored(lines(docs), "lines")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    salted = frequent_lines(seen, max_documents).select("_host", "hash", salts)
    found = seen.withColumn("_salt", F.pmod("_content", F.lit(SALTS)).cast("int")).join(salted, ["_host", "hash", "_salt"])
    # A set per document, of its own line numbers; repeated rows share a key and add nothing.
    return found.groupBy(*_KEY).agg(F.collect_set(F.struct("number", "chars")).alias("removed"))


def _verdict(counted: DataFrame, removed: DataFrame, min_left: int):
    """``counted`` with ``removed`` lines, ``depleted`` and ``kept``."""
    joined = counted.join(removed.hint("merge"), same(counted, removed, _KEY), "left").drop(*[removed[k] for k in _KEY])
    lost = F.aggregate(F.transform("removed", lambda s: s["chars"]), F.lit(0).cast("long"), lambda total, n: total + n)
    depleted = F.coalesce(100 * (F.col("_chars") - lost) < min_left * F.col("_chars"), F.lit(False))
    return joined.withColumn("depleted", depleted).withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))


def judge(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_left: int = MIN_LEFT) -> DataFrame:
    """One row per document row: ``doc_id``, base counts, ``base_failed``, ``kept``, ``n_removed_lines``."""
    judged = _verdict(base_counts(_keyed(docs)), removed_lines(docs, max_documents), min_left)
    return judged.select(F.col("_id").alias("doc_id"), *_COUNTS, "kept",
                         F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed_lines"))


def clean(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_left: int = MIN_LEFT) -> DataFrame:
    """The kept documents with all their columns; frequent lines are gone from the text, and ``n_chars`` follows."""
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    removed = stored(removed_lines(docs, max_documents), "removed-lines")
    # One condition on both sides of the join: pushed below it, the counts would be computed inside the filter.
    judged = _verdict(base_counts(_keyed(docs, row)), removed, min_left).filter(
        F.col("base_failed").cast("int") + F.col("depleted").cast("int") == 0)
    numbers = F.transform("removed", lambda s: s["number"])
    text = F.when(F.col("removed").isNull(), F.col("_row.text")).otherwise(F.array_join(F.filter(
        F.split("_row.text", "\n"), lambda x, i: ~F.array_contains(numbers, i)), "\n"))
    new = {"text": text, "n_chars": F.when(F.col("removed").isNull(), F.col("_row.n_chars")).otherwise(F.length(text).cast("long"))}
    return judged.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
