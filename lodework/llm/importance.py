"""Importance resampling towards a target distribution over hashed word n-grams.

Features are all runs of one to three words of a text; a feature's bucket is the CRC-32 of
its bytes modulo ``BUCKETS``. How much more frequent a bucket is in the target than in the
documents is its gain; a document's weight is the sum of the gains of its features, and
weight plus Gumbel noise from a hash of the id is its score. The best scores are drawn, which
samples without replacement in proportion to exp(weight).

*Checksums.* CRC-32 without its constants is linear over XOR: the checksum of a span is the
XOR of one precomputed contribution per (distance from the span's end, byte), and a constant
of the span's length. Words are laid out once with single blanks between them, so every
feature is a span of that layout, and ``bitwise_xor.reduceat`` folds all spans of a slice at
once. Spans longer than the position table are cut into blocks of the table's length counted
from their end; block values are folded by the linear map that appends a block of zeros.

Counts are exact and cover all documents: a task sends at most ``BUCKETS`` sums, and the
gains (``BUCKETS`` numbers) are all that goes back. Only the scores of eligible documents
are ordered, by one range shuffle, and no text moves.

NULL and empty texts have no features, weight 0, and are never drawn; very long texts are
worked on in slices of words. A NULL id is hashed as an empty one and comes last among ties;
repeated rows are documents of their own. Without documents or without a target the sums are
0. Extra columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodework.functions.ranking import By, numbered
from lodework.llm.common import stored

# Fixed values of the sampling rule.
BUCKETS = 10_000
WORDS_OF_FEATURE = 3
SEED = 42
LEAST_WORDS = 20
PERCENT = 5

#: Bytes of a span that the position table covers.
REACH = 96
#: Words whose features are folded at once.
SLICE = 1 << 13


def _position_table() -> np.ndarray:
    """Contribution of each byte (second axis) at each distance from the end, flattened."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    table = np.empty((REACH, 256), np.uint32)
    table[0] = step
    for distance in range(1, REACH):
        before = table[distance - 1]
        table[distance] = (before >> 8) ^ step[before & 0xFF]
    return table.ravel()


_TABLE = _position_table()
_BLANKS = np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)


def _appended(value: np.ndarray) -> np.ndarray:
    """The linear part of a checksum after ``REACH`` zero bytes: its four bytes, each at its distance from the end."""
    last = _TABLE.reshape(REACH, 256)
    return (last[REACH - 1][value & 0xFF] ^ last[REACH - 2][(value >> 8) & 0xFF]
            ^ last[REACH - 3][(value >> 16) & 0xFF] ^ last[REACH - 4][value >> 24])


def _folded(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XOR of the contributions of each span's bytes; spans are not empty and within ``REACH``."""
    ends = np.cumsum(lengths)
    firsts = ends - lengths
    place = np.arange(ends[-1], dtype=np.int64)
    distance = np.repeat(ends - 1, lengths) - place
    values = data[place + np.repeat(starts - firsts, lengths)]
    return np.bitwise_xor.reduceat(_TABLE[(distance << 8) | values], firsts)


def checksums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``data`` (bytes)."""
    made = np.zeros(len(starts), np.uint32)
    if not len(starts):
        return made
    short = np.flatnonzero(lengths <= REACH)
    if len(short):
        made[short] = _folded(data, starts[short], lengths[short]) ^ _BLANKS[lengths[short]]
    for i in np.flatnonzero(lengths > REACH):
        made[i] = _long(data, int(starts[i]), int(lengths[i]))
    return made


def _long(data: np.ndarray, start: int, length: int) -> int:
    """CRC-32 of one span beyond the table, block by block; some blocks at a time, so its length is no matter."""
    value = np.zeros(1, np.uint32)
    head = length % REACH
    if head:
        value ^= _folded(data, np.array([start]), np.array([head]))
    for low in range(start + head, start + length, REACH * SLICE):
        count = min(SLICE, (start + length - low) // REACH)
        for block in _folded(data, low + REACH * np.arange(count), np.full(count, REACH)):
            value = _appended(value) ^ block
    return int(value[0]) ^ zlib.crc32(bytes(length))


# Bytes of words, and ASCII capitals as small letters.
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in _LOWER.tolist()])


def layout(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of texts, joined by single blanks: bytes, where words start, their lengths, and their texts."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), none, none, none
    lower = _LOWER[data]
    inside = _IN_WORD[lower]
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    edge[bounds[:-1][bounds[:-1] < len(data)]] = True
    runs = np.flatnonzero(edge)
    runs_end = np.append(runs[1:], len(data))
    are_words = inside[runs]
    begin, end = runs[are_words], runs_end[are_words]
    lengths = end - begin
    starts = np.cumsum(lengths + 1) - lengths - 1
    joined = np.full(int(lengths.sum() + len(lengths)), 32, np.uint8)
    kept = lower[inside]
    joined[np.arange(len(kept)) + np.repeat(np.arange(len(lengths)), lengths)] = kept
    return joined, starts, lengths, np.searchsorted(bounds, begin, "right") - 1


def features(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of words and lengths of features: the length, the features' buckets, and the texts they are of."""
    joined, starts, lengths, text = layout(data, bounds)
    for low in range(0, len(starts), SLICE):
        for n in range(1, WORDS_OF_FEATURE + 1):
            first = np.arange(low, min(low + SLICE, len(starts) - n + 1))
            if not len(first):
                continue
            last = first + n - 1
            one = text[first] == text[last]
            first, last = first[one], last[one]
            yield n, checksums(joined, starts[first], starts[last] + lengths[last] - starts[first]) % BUCKETS, text[first]


def _bytes(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of some megabytes (at least one text): first and last, their bytes, and where each begins and ends."""
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + (1 << 22), "right")) - 1)
        size = int(bounds[last] - bounds[first])
        held = np.frombuffer(texts.buffers()[2], np.uint8, size, int(bounds[first])) if size else np.zeros(0, np.uint8)
        yield first, last, held, bounds[first:last + 1] - bounds[first]
        first = last


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, held, bounds in _bytes(batch.column("text")):
            for _, bucket, _ in features(held, bounds):
                total += np.bincount(bucket, minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n): features of all ``text``, counted in the tasks before they meet."""
    counted = texts.select("text").mapInArrow(_counted, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each bucket, from at most ``BUCKETS`` sums of either side."""
    def sums(df: DataFrame) -> np.ndarray:
        made = np.zeros(BUCKETS, np.int64)
        for row in bucket_counts(df).collect():
            made[row["bucket"]] = row["n"]
        return made

    s, t = sums(documents), sums(target)
    ratio = ((t + 1) * float(s.sum() + BUCKETS)) / ((s + 1) * float(t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """``documents`` (doc_id, text) as (doc_id, n_words, n_features, weight)."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((3, batch.num_rows), np.int64)
            for first, last, held, bounds in _bytes(batch.column("text")):
                size = last - first
                for n, bucket, text in features(held, bounds):
                    count = np.bincount(text, minlength=size)
                    if n == 1:
                        found[0, first:last] += count
                    found[1, first:last] += count
                    found[2, first:last] += np.bincount(text, gain[bucket], size).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, found)], names=["doc_id", "n_words", "n_features", "weight"])

    return documents.select("doc_id", "text").mapInArrow(judge, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column) -> Column:
    """Gumbel noise in thousandths, from a hash of the id."""
    told = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(told.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def resample(documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` of the drawn (else NULL).

    Of the documents with ``least_words`` words, ``percent`` percent (rounded down) are drawn.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = weighed(docs, gains(docs, target)).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    scored = stored(scored, "importance-scores")
    eligible = F.col("n_words") >= least_words
    drawn = scored.filter(eligible).select(F.floor(F.count(F.lit(1)) * percent / 100)).scalar()
    placed = numbered(scored.filter(eligible), "rank", [By("score", descending=True), By("doc_id")])
    ranked = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(~eligible).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
