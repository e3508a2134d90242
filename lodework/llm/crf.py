"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is good or bad. A line's features are intervals of its own measures
(shares of kinds of characters, length, words, how much it repeats itself or another line)
and of those of the lines before and after it; the chain adds how labels follow each other.
Forward-backward gives each line's probability of being good, and a document's score is
their mean weighted by the lines' characters.

The chain is evaluated as a product of 2 x 2 matrices over all lines of many documents at
once: a document's first line forgets what was before it. Products run inside blocks of
lines side by side and then from block to block, so a document of millions of lines costs
no more than many short ones.

Labels are known for documents only, so a learning document's lines all bear its label. The
field is fitted by gradient steps on the likelihood on a bounded sample: at most
``PER_LABEL`` documents of each label, drawn by a hash of the id, of at most
``LEARN_CHARS`` characters, weighted so that labels keep their shares. Scoring reads whole
texts and nothing else.

NULL and empty texts, and texts without a word, have no line and score 0. Rows with a NULL
id count as not held out. Ids whose labels disagree, and labels other than 0 and 1, are not
learned from; without labels of both kinds every other score is 0.5. Repeated rows, ties,
long texts and extra columns need no care; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_LABEL = 4000
LEARN_CHARS = 200_000
#: Intervals per measure, gradient steps and their size, penalty on weights.
INTERVALS, STEPS, RATE, PENALTY = 8, 150, 0.2, 1e-4
HELD_OUT, GOOD_FROM = 5, 0.3

# Kinds of bytes. Lower, upper, digit, space, beyond ASCII, stops, calls, symbols, others.
_KINDS = 9
_KIND = np.full(256, 8, np.uint8)
for _kind, _members in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\x0b\x0c\r")):
    _KIND[[ord(c) for c in _members]] = _kind
_KIND[128:] = 4
for _kind, _members in ((5, ".,;:'\"-()"), (6, "!?"), (7, "#*$%&|<>")):
    _KIND[[ord(c) for c in _members]] = _kind
_SPACE = 3
MEASURES = _KINDS + 6
_STEP = 1 << 20
_POWERS = (np.uint64(0x9E3779B97F4A7C15) * (2 * np.arange(64, dtype=np.uint64) + np.uint64(1)))


def _runs(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end: bytes other than space, between ``breaks``."""
    inside = _KIND[data] != _SPACE
    edge = np.ones(len(data), bool)
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    edge[breaks[breaks < len(data)]] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(data))
    kept = inside[starts]
    return starts[kept], ends[kept]


def lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines with a word of texts given as bytes: measures, text, and characters (bytes that begin one)."""
    breaks = np.unique(np.concatenate([bounds[:-1], np.flatnonzero(data == 10) + 1]))
    breaks = breaks[breaks < len(data)]
    begin, end = _runs(data, breaks)
    if not len(begin):
        return np.zeros((0, MEASURES), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    line_of_word = np.searchsorted(breaks, begin, "right") - 1
    used, word_line = np.unique(line_of_word, return_inverse=True)
    number = np.full(len(breaks), len(used))
    number[used] = np.arange(len(used))
    kinds = np.zeros((len(used) + 1) * _KINDS, np.int64)
    chars = np.zeros(len(used) + 1, np.int64)
    for low in range(0, len(data), _STEP):
        part = data[low:low + _STEP]
        at = number[np.searchsorted(breaks, np.arange(low, low + len(part)), "right") - 1]
        kinds += np.bincount(at * _KINDS + _KIND[part], minlength=len(kinds))
        chars += np.bincount(at, (part & 0xC0) != 0x80, len(chars)).astype(np.int64)
    kinds, chars = kinds.reshape(-1, _KINDS)[:-1].astype(np.float64), chars[:-1]
    length = kinds.sum(1)
    words = np.bincount(word_line, minlength=len(used)).astype(np.float64)
    hashes = _hashes(data, begin, end)
    order = np.lexsort((hashes, word_line))
    sorted_line, sorted_hash = word_line[order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_line[1:] != sorted_line[:-1]) | (sorted_hash[1:] != sorted_hash[:-1])
    distinct = np.bincount(sorted_line[new], minlength=len(used))
    same = np.zeros(len(begin))
    same[1:] = (hashes[1:] == hashes[:-1]) & (word_line[1:] == word_line[:-1])
    text = np.searchsorted(bounds, breaks[used], "right") - 1
    whole = np.zeros(len(used), np.uint64)
    np.add.at(whole, word_line, hashes * (np.arange(len(hashes), dtype=np.uint64) - np.searchsorted(word_line, word_line).astype(np.uint64) + np.uint64(1)))
    _, twin, copies = np.unique(np.stack([text.astype(np.uint64), whole]), axis=1, return_inverse=True, return_counts=True)
    measures = np.column_stack([
        kinds / length[:, None], np.log1p(length), np.log1p(words), (length - kinds[:, _SPACE]) / words, distinct / words,
        np.bincount(word_line, same, len(used)) / words, copies[twin.ravel()] > 1])
    return measures.astype(np.float32), text, chars


def _hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word, from slices of words."""
    made = np.empty(len(begin), np.uint64)
    for low in range(0, len(begin), _STEP >> 3):
        b, n = begin[low:low + (_STEP >> 3)], (end - begin)[low:low + (_STEP >> 3)]
        firsts = np.cumsum(n) - n
        into = np.arange(int(n.sum())) - np.repeat(firsts, n)
        value = (data[into + np.repeat(b, n)].astype(np.uint64) + np.uint64(1)) * _POWERS[into & 63]
        value ^= value >> np.uint64(29)
        made[low:low + len(b)] = np.add.reduceat(value * np.uint64(0xBF58476D1CE4E5B9), firsts) + n.astype(np.uint64)
    return made


def _texts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of some megabytes (at least one text): first and last, bytes, and where each begins and ends."""
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + (1 << 22), "right")) - 1)
        size = int(bounds[last] - bounds[first])
        data = np.frombuffer(texts.buffers()[2], np.uint8, size, int(bounds[first])) if size else np.zeros(0, np.uint8)
        yield first, last, data, bounds[first:last + 1] - bounds[first]
        first = last


# --- the chain -------------------------------------------------------------------------------------

def _carried(steps: np.ndarray) -> np.ndarray:
    """Row vectors (1, 1) S1 ... St for every t, each scaled to sum 1; steps: (lines, 2, 2), positive."""
    n = len(steps)
    size = max(1, int(np.sqrt(n)))
    blocks = -(-n // size)
    padded = np.broadcast_to(np.eye(2), (blocks * size, 2, 2)).copy()
    padded[:n] = steps
    padded = padded.reshape(blocks, size, 2, 2)
    for k in range(1, size):
        product = padded[:, k - 1] @ padded[:, k]
        padded[:, k] = product / product.sum((1, 2), keepdims=True)
    entering = np.empty((blocks, 2))
    vector = np.ones(2)
    for b in range(blocks):
        entering[b] = vector
        vector = vector @ padded[b, -1]
        vector = vector / vector.sum()
    out = np.einsum("bi,bkij->bkj", entering, padded).reshape(-1, 2)[:n]
    return out / out.sum(1, keepdims=True)


def marginals(scores: np.ndarray, first: np.ndarray, follow: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per line the probabilities of bad and good, and the vectors they come from.

    scores: log odds of good from the line itself; first: whether a line opens a document;
    follow, start: log weights of a label after another, and on a first line.
    """
    good = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
    own = np.column_stack([1 - good, good])
    steps = np.where(first[:, None, None], np.exp(start)[None, None, :], np.exp(follow)[None]) * own[:, None, :]
    ahead = _carried(steps)
    behind = np.ones_like(ahead)
    if len(steps) > 1:
        behind[:-1] = _carried(steps[:0:-1].transpose(0, 2, 1))[::-1]
    both = ahead * behind
    return both / both.sum(1, keepdims=True), ahead, behind, steps


class Field:
    """Limits of the intervals of measures, weights per (place, measure, interval), and the chain's weights."""

    def __init__(self, limits: np.ndarray):
        self.limits = limits
        self.weights = np.zeros(3 * MEASURES * (INTERVALS + 1) + 1)
        self.follow, self.start = np.zeros((2, 2)), np.zeros(2)

    def active(self, measures: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Indices of a line's active features: one interval per measure of the line, the one before, the one after."""
        here = np.empty(measures.shape, np.int64)
        for m in range(MEASURES):
            here[:, m] = m * (INTERVALS + 1) + np.searchsorted(self.limits[m], measures[:, m], "right")
        size = MEASURES * (INTERVALS + 1)
        none = 3 * size
        before, after = np.full_like(here, none), np.full_like(here, none)
        inner = ~first[1:]
        before[1:][inner] = here[:-1][inner] + size
        after[:-1][inner] = here[1:][inner] + 2 * size
        return np.concatenate([here, before, after], 1)

    def fit(self, measures: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        """Gradient steps (Adam) on the penalised log likelihood of the labels; ``weight`` per line is its document's."""
        active = self.active(measures, first)
        inner = ~first[1:]
        truth = np.bincount((2 * label[:-1] + label[1:])[inner], weight[1:][inner], 4).reshape(2, 2)
        begun = np.bincount(label[first], weight[first], 2)
        total = weight.sum()
        state = [np.zeros(self.weights.size + 6) for _ in range(2)]
        for step in range(1, STEPS + 1):
            both, ahead, behind, steps = marginals(self.weights[active].sum(1), first, self.follow, self.start)
            pairs = ahead[:-1, :, None] * steps[1:] * behind[1:, None, :]
            pairs = (pairs / pairs.sum((1, 2), keepdims=True))[inner]
            pull = weight * (label - both[:, 1])
            by_weight = np.bincount(active.ravel(), np.repeat(pull, active.shape[1]), self.weights.size)
            by_pair = truth - (weight[1:][inner][:, None, None] * pairs).sum(0)
            by_start = begun - (weight[first][:, None] * both[first]).sum(0)
            now = np.concatenate([self.weights, self.follow.ravel(), self.start])
            slope = np.concatenate([by_weight, by_pair.ravel(), by_start]) / total - PENALTY * now
            state[0] = 0.9 * state[0] + 0.1 * slope
            state[1] = 0.99 * state[1] + 0.01 * slope ** 2
            now += RATE * state[0] / (1 - 0.9 ** step) / (np.sqrt(state[1] / (1 - 0.99 ** step)) + 1e-8)
            self.weights, self.follow, self.start = now[:-6], now[-6:-2].reshape(2, 2), now[-2:]
        self.weights[-1] = 0

    def good(self, measures: np.ndarray, first: np.ndarray) -> np.ndarray:
        return marginals(self.weights[self.active(measures, first)].sum(1), first, self.follow, self.start)[0][:, 1]


def _opens(text: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.zeros(0, bool)


# --- learning and scoring --------------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [b"" for _ in range(batch.num_rows)]
        for first, last, data, bounds in _texts(batch.column("text")):
            measures, text, _ = lines(data, bounds)
            cuts = np.searchsorted(text, np.arange(last - first + 1))
            found[first:last] = [measures[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("share"), pa.array(found, pa.binary())],
                                         names=["label", "share", "lines"])


def learn(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Field | None:
    """The field fitted on the sample; None without labels of both kinds."""
    told = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("_most")).filter(F.col("label") == F.col("_most"))
    sizes = {r["label"]: r["n"] for r in told.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    drawn = None
    for label, n in sorted(sizes.items()):
        some = told.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label).select(
            F.col("doc_id").alias("_learned"), F.col("label").cast("long"), F.lit(n / min(n, per_label)).alias("share"))
        drawn = some if drawn is None else drawn.unionByName(some)
    # Twice ``per_label`` ids at most.
    short = documents.select("doc_id", "text").filter(F.length("text").between(1, LEARN_CHARS))
    texts = short.join(F.broadcast(drawn), F.col("doc_id") == F.col("_learned")).dropDuplicates(["doc_id"])
    sample = texts.select("label", "share", "text").mapInArrow(_measured, "label long, share double, lines binary").collect()
    measured = [(np.frombuffer(r["lines"], np.float32).reshape(-1, MEASURES), r["label"], r["share"]) for r in sample if r["lines"]]
    if len({label for _, label, _ in measured}) < 2:
        return None
    measured.sort(key=lambda t: (t[1], t[0].tobytes()))
    sizes = np.array([len(m) for m, _, _ in measured])
    measures = np.concatenate([m for m, _, _ in measured])
    label = np.repeat([y for _, y, _ in measured], sizes)
    # A document counts once however many lines it has.
    weight = np.repeat([s for _, _, s in measured] / sizes, sizes)
    limits = np.quantile(measures, np.arange(1, INTERVALS + 1) / (INTERVALS + 1), axis=0).T.astype(np.float32)
    field = Field(limits)
    field.fit(measures, _opens(np.repeat(np.arange(len(sizes)), sizes)), label, weight)
    return field


def score(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    field = learn(docs, labels, per_label)

    @F.pandas_udf("double")
    def judged(texts):
        found = np.zeros(len(texts))
        for first, last, data, bounds in _texts(pa.array(texts, pa.large_string(), from_pandas=True)):
            measures, text, chars = lines(data, bounds)
            if len(text):
                good = field.good(measures, _opens(text)) if field else np.full(len(text), 0.5)
                size = np.bincount(text, chars, last - first)
                found[first:last] = np.bincount(text, good * chars, last - first) / np.maximum(size, 1)
        import pandas as pd
        return pd.Series(np.clip(found, 0, 1))

    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), judged("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD_FROM).cast("int"))
