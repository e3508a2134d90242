"""Byte-pair encoding of whole texts, with content-defined chunks that are encoded once and reused.

A rolling hash over the last 16 bytes cuts every text into chunks, so equal passages of
different documents give equal chunks wherever they stand. A worker encodes each distinct
chunk once and keeps the result. A cut may fall inside a word; then the ends of the two
chunks are encoded anew, as one, up to the nearest white space on both sides: there the
encoding with the cut and the one without agree exactly, because no token crosses white
space that the tokenizer drops. A chunk without white space is joined to the next one, as
often as needed.

The dictionary lives in the Python worker, across its tasks, and is bounded. Making it
global would move the text once and the ids once; see the README for the figures.

NULL and empty texts give no ids; texts of any length are encoded whole; each row stands
for itself, so ids, repeated rows, ties and extra columns do not matter, and an empty
table gives an empty result. Tokenizers whose pieces may cross white space are run on
whole texts instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from lodework.llm.pieces import Pieces, pieces

#: A cut is made on average every 2 ** CUT_BITS bytes.
CUT_BITS = 8
WINDOW = 16
REMEMBERED_CHUNKS = 20_000
_STEP = 1 << 21  # bytes whose cuts are sought at once

_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(data: np.ndarray, cut_bits: int = CUT_BITS) -> np.ndarray:
    """Positions before which the bytes ``data`` are cut; never inside a character."""
    rolled = _GEAR[data]
    for width in (1, 2, 4, 8):
        rolled[width:] += rolled[:-width] << np.uint32(width)
    hit = (rolled >> np.uint32(32 - cut_bits)) == 0 if cut_bits else np.ones(len(data), bool)
    hit &= (data & 0xC0) != 0x80
    return np.flatnonzero(hit)


class ChunkEncoder:
    """Encodes texts through a dictionary of chunks."""

    def __init__(self, own: Pieces, cut_bits: int = CUT_BITS, remembered: int = REMEMBERED_CHUNKS):
        self._pieces, self._cut_bits, self._size = own, cut_bits, remembered
        # Two generations of half the size: the older one goes when the newer is full, and what is met again is new.
        self._chunks: dict[bytes, tuple] = {}
        self._older: dict[bytes, tuple] = {}

    def _chunk(self, chunk: bytes):
        """(start up to white space, ids of the inside, end after white space); no inside without white space."""
        known = self._chunks.get(chunk)
        if known is not None:
            return known
        known = self._older.get(chunk)
        if known is None:
            parts = chunk.replace(b"\n", b" ").split(b" ")
            if len(parts) == 1:
                return None
            known = (parts[0], b"".join(map(self._pieces.words.__getitem__, parts[1:-1])), parts[-1])
        if len(self._chunks) >= self._size // 2:
            self._older, self._chunks = self._chunks, {}
        self._chunks[chunk] = known
        return known

    def join(self, chunks: Iterator[bytes]) -> bytes:
        """Ids of the text that the chunks make up."""
        words, out, begun = self._pieces.words, [], b""
        for chunk in chunks:
            known = self._chunk(chunk)
            if known is None:
                begun += chunk
                continue
            out += (words[begun + known[0]], known[1])
            begun = known[2]
        out.append(words[begun])
        return b"".join(out)

    def encode(self, data: bytes, bounds: np.ndarray) -> list[bytes]:
        """Ids of the texts that lie in ``data`` between consecutive ``bounds``."""
        found, start = [], 0
        while start < len(bounds) - 1:
            stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + _STEP, "right")) - 1)
            low, high = int(bounds[start]), int(bounds[stop])
            at = cuts(np.frombuffer(data, np.uint8, high - low, low), self._cut_bits) + low if high > low else np.empty(0, np.int64)
            for a, b in zip(bounds[start:stop].tolist(), bounds[start + 1:stop + 1].tolist()):
                # A cut in the first bytes would depend on the text before.
                own = at[np.searchsorted(at, a + (WINDOW if self._cut_bits else 1)):np.searchsorted(at, b)].tolist()
                found.append(self.join(data[x:y] for x, y in zip([a, *own], [*own, b])))
            start = stop
        return found


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def encode_array(texts: pa.Array, path: str, cut_bits: int = CUT_BITS) -> pa.Array:
    """Ids of an Arrow array of texts, as a list array; NULL gives an empty list."""
    own = pieces(path)
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return pa.array([], pa.list_(pa.int32()))
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = data.to_pybytes() if data is not None else b""
    if own.mode == "dropped":
        encoder = _ENCODERS.setdefault((path, cut_bits), ChunkEncoder(own, cut_bits))
        found = encoder.encode(data, bounds)
    else:
        found = [own.whole(data[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found])))
    values = np.frombuffer(b"".join(found), np.int32)
    if ends[-1] < 2**31:
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(values)).cast(pa.large_list(pa.int32()))


def decode_array(ids: pa.Array, path: str) -> pa.Array:
    own = pieces(path)
    ids = ids.cast(pa.large_list(pa.int32()))
    if len(ids) == 0:
        return pa.array([], pa.large_string())
    ends = ids.offsets.to_numpy()
    values = ids.values.fill_null(-1).to_numpy(zero_copy_only=False)
    texts = [own.decode(values[a:b].tolist()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return pa.array(texts, pa.large_string(), mask=ids.is_null().to_numpy(zero_copy_only=False))


def _slices(texts: pa.Array, size: int = _STEP) -> Iterator[pa.Array]:
    """Runs of about ``size`` bytes, so that no more than a run's ids are held at once."""
    lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def encode(text: Column, path: str, cut_bits: int = CUT_BITS) -> Column:
    """Ids of a text column: ``array<int>``, never NULL."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in _slices(texts):
                yield encode_array(part, path, cut_bits)

    return F.arrow_udf(run, "array<int>")(text)


def decode(ids: Column, path: str) -> Column:
    """Text of an ``array<int>`` column of ids; special tokens are kept; NULL stays NULL."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for listed in batches:
            yield decode_array(listed, path)

    return F.arrow_udf(run, "string")(ids)


def round_trip(text: Column, path: str, cut_bits: int = CUT_BITS) -> Column:
    """``struct<ids, decoded>`` of a text column, in one pass of one worker."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in _slices(texts):
                ids = encode_array(part, path, cut_bits)
                yield pa.StructArray.from_arrays([ids, decode_array(ids, path).cast(pa.string())], names=["ids", "decoded"])

    return F.arrow_udf(run, "ids array<int>, decoded string")(text)
