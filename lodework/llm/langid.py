"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1; for each bit a binary classifier over hashed
byte n-grams tells the languages with +1 from those with -1. A text's bits are margins,
and the language whose codeword has the least weighted logistic loss against them wins
(loss-weighted decoding: a bit counts for a language as much as the classifier was right
on that language's learning texts). A text whose runner-up comes close is ``ambiguous``.

The classifiers learn from at most about ``PER_LANGUAGE`` texts of each language, drawn by
a hash of the id (a documented bound; n-gram counts of the drawn texts are summed by
Spark, and only languages x ``FEATURES`` sums reach the driver). Prediction reads whole
texts and nothing else.

NULL texts and texts without a letter are ``und`` with score 0; so is everything when no
row has a label. Rows with a NULL id count as not held out and are not learned from.
Repeated rows, ties (the first language in order wins), long texts and extra columns
need no care; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_LANGUAGE = 3000
FEATURES = 1 << 14
CLOSE = 0.02
NO_LANGUAGE = "und"
_ORDERS = (1, 2, 3)
_STEP = 1 << 18

# ASCII letters in lower case, other ASCII characters as one blank, other bytes as they are.
_FOLD = np.array([b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def codewords(n: int) -> np.ndarray:
    """``n`` codewords: all splits of the languages for few of them, else well separated draws."""
    if n < 2:
        return np.ones((n, 0), np.float32)
    if n <= 5:
        columns = [(1, *rest) for rest in product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(columns, np.float32).T
    length, best, apart = 4 * int(np.ceil(np.log2(n))) + 8, None, -1
    for draw in range(200):
        code = np.random.default_rng(draw).choice(np.array([-1, 1], np.float32), (n, length))
        least = min(int((code[i] != code[:i]).sum(1).min()) for i in range(1, n))
        if least > apart and (np.abs(code.sum(0)) < n).all():
            best, apart = code, least
    return best


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of an Arrow array of texts, and where each text begins and ends."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    return np.frombuffer(texts.buffers()[2], np.uint8, int(bounds[-1] - bounds[0]), int(bounds[0])), bounds - bounds[0]


def _grams(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of bytes: hashed n-grams, the texts that hold some, and where each such text's n-grams begin."""
    lengths = np.diff(bounds)
    for low in range(0, int(bounds[-1]), _STEP):
        high = min(low + _STEP, int(bounds[-1]))
        first, last = np.searchsorted(bounds, low, "right") - 1, np.searchsorted(bounds, high, "left")
        some = np.arange(first, last)[lengths[first:last] > 0]
        begins = np.maximum(bounds[some], low) - low
        left = np.repeat(bounds[some + 1], np.diff(np.append(begins, high - low))) - np.arange(low, high)
        folded = _FOLD[data[low:min(high + max(_ORDERS) - 1, len(data))]]
        gram = np.zeros(len(folded), np.uint32)
        for order in _ORDERS:
            gram = (gram[:len(folded) - order + 1] << np.uint32(8)) | folded[order - 1:]
            hashed = (gram + np.uint32(order)) * np.uint32(2654435761) >> np.uint32(32 - FEATURES.bit_length() + 1)
            hashed = hashed[:high - low]
            keep = left[:len(hashed)] >= order
            if not keep.all():
                counted = np.add.reduceat(keep.astype(np.int64), begins[begins < len(hashed)])
                has = counted > 0
                yield hashed[keep], some[begins < len(hashed)][has], np.concatenate(([0], np.cumsum(counted)[:-1]))[has]
            else:
                yield hashed, some, begins


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = _buffers(batch.column("text"))
        names = batch.column("lang").to_pylist()
        listed = sorted(set(names))
        code = np.array([listed.index(x) for x in names])
        total = np.zeros((len(listed), FEATURES), np.int64)
        for hashed, some, begins in _grams(data, bounds):
            own = np.repeat(code[some], np.diff(np.append(begins, len(hashed))))
            total += np.bincount(own * FEATURES + hashed, minlength=total.size).reshape(total.shape)
        row, feature = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([listed[i] for i in row], pa.string()), pa.array(feature, pa.int32()), pa.array(total[row, feature])],
            names=["lang", "feature", "n"])


class Model:
    """Languages, their codewords, the bits' n-gram weights, and how much a bit counts for a language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.code = languages, codewords(len(languages))
        share = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * FEATURES)
        plus, minus = self.code.T > 0, self.code.T < 0
        self.bits = np.ascontiguousarray(np.stack(
            [np.log(share[p].mean(0)) - np.log(share[m].mean(0)) for p, m in zip(plus, minus)], 1).astype(np.float32)
            if self.code.shape[1] else np.zeros((FEATURES, 0), np.float32))
        self.trust = np.ones(self.code.shape, np.float32)

    def margins(self, texts: pa.Array) -> np.ndarray:
        """Sum of weights of a text's n-grams over the root of their number, per bit."""
        data, bounds = _buffers(texts)
        total, n = np.zeros((len(texts), self.code.shape[1]), np.float64), np.zeros(len(texts))
        if self.code.shape[1]:
            for hashed, some, begins in _grams(data, bounds):
                if len(some):
                    total[some] += np.add.reduceat(self.bits[hashed], begins, axis=0)
                    n[some] += np.diff(np.append(begins, len(hashed)))
        return total / np.sqrt(np.maximum(n, 1))[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, score, and whether the second nearest is close."""
        weight = self.trust / np.maximum(self.trust.sum(1, keepdims=True), 1e-9)
        loss = (np.logaddexp(0, -margins[:, None, :] * self.code[None]) * weight[None]).sum(2)
        best = loss.argmin(1)
        shares = np.exp(loss.min(1, keepdims=True) - loss)
        ordered = np.sort(loss, 1)
        close = ordered[:, 1] - ordered[:, 0] < CLOSE if loss.shape[1] > 1 else np.zeros(len(loss), bool)
        return best, 1 / shares.sum(1), close


def drawn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Learning texts: ``lang`` and ``text`` of about ``per_language`` labelled documents of each language."""
    able = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder() != 2))
    # One number per class of the classifier.
    numbers = {r["lang"]: r["n"] for r in able.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    place, chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)), F.lit(False)
    for lang, n in sorted(numbers.items()):
        chosen = F.when(F.col("lang") == lang, place < (1 << 20) * per_language // n).otherwise(chosen)
    return able.filter(chosen).select("lang", "text")


def remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn the codes' classifiers from the documents that are not held out."""
    learning = drawn(docs, per_language)
    sums = (learning.mapInArrow(_counts, "lang string, feature int, n long")
            .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(sums["lang"].unique().tolist())
    counts = np.zeros((len(languages), FEATURES), np.int64)
    counts[np.searchsorted(languages, sums["lang"]) if len(sums) else [], sums["feature"]] = sums["n"]
    model = Model(languages, counts)

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = model.code[np.searchsorted(model.languages, batch.column("lang").to_pylist())]
            ok = (model.margins(batch.column("text")) * own > 0)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(ok.astype(np.int64).tolist(), pa.list_(pa.int64()))],
                                             names=["lang", "ok"])

    if model.code.shape[1]:
        bits = model.code.shape[1]
        told = learning.mapInArrow(right, "lang string, ok array<long>").groupBy("lang").agg(
            *[F.avg(F.get("ok", F.lit(b))).alias(str(b)) for b in range(bits)]).collect()
        for r in told:
            model.trust[model.languages.index(r["lang"])] = [r[str(b)] for b in range(bits)]
    return model


def predict(text: Column, model: Model) -> Column:
    """``struct<lang_pred, score, ambiguous>`` of a text column."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lettered in batches:
            n = len(texts)
            known = np.array(lettered.fill_null(False).to_pylist(), bool) & bool(model.languages)
            best, score, close = model.decode(model.margins(texts)) if n and model.languages else (
                np.zeros(n, int), np.zeros(n), np.zeros(n, bool))
            names = [model.languages[i] if k else NO_LANGUAGE for i, k in zip(best.tolist(), known.tolist())]
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0), pa.float64()), pa.array(close & known)],
                names=["lang_pred", "score", "ambiguous"])

    return F.arrow_udf(run, "lang_pred string, score double, ambiguous boolean")(text, text.rlike("\\p{L}"))


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per document row: ``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``ambiguous``."""
    told = docs.select("doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"),
                       predict(F.col("text"), fit(docs, per_language)).alias("told"))
    return told.select("doc_id", "held_out", "told.lang_pred", "told.score", "told.ambiguous")


def clean(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The documents, with all their columns, whose language is told without ambiguity."""
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    told = docs.select(row, predict(F.col("text"), fit(docs, per_language)).alias("_told"))
    return told.filter((F.col("_told.lang_pred") != NO_LANGUAGE) & ~F.col("_told.ambiguous")).select("_row.*")
