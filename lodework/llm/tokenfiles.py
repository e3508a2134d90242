"""Token ids of documents in binary files, with Elias-Fano encoded document boundaries.

Documents are dealt out by ranges of ``doc_id``, tokenized and written in that order. A file holds the ids of its documents one after another (16 bits
each if the vocabulary allows it, else 32), then the boundaries, the document ids and a
trailer with the lengths of these parts. The boundaries 0 = b0 <= b1 <= ... are split into low
bits, packed, and high parts in unary; every ``SAMPLE``-th set bit of the latter has its
position noted, so a boundary is found by a jump and a short scan, in about
2 + log2(ids per document) bits each instead of 64.

NULL and empty texts are documents with the end id alone. NULL ids come first, repeated
rows and equal ids stay (ordered by a hash of the text); a text of any length is encoded
whole; an empty table makes no file; extra columns do not matter. A task's file counts only
once the task has returned its name, so lost or repeated attempts leave no trace.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodework.llm.common import stored
from lodework.llm.files import attempt_name, create, open_file, shared_folder
from lodework.llm.pieces import pieces

END = 0
SAMPLE = 256
_MAGIC = b"EFIDS1"
_TRAILER = struct.Struct("<6sBBQQQQQQ")
_READ = 1 << 22


class EliasFano:
    """A non-decreasing sequence of integers from 0 on, in near-minimal space."""

    def __init__(self, n: int, low_bits: int, high: np.ndarray, low: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.high, self.low, self.samples = n, low_bits, high, low, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        high[places] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
        return cls(n, low_bits, np.packbits(high, bitorder="little"), np.packbits(low, bitorder="little"),
                   places[::SAMPLE].astype(np.uint32))

    def _lows(self, first: int, count: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(count, np.int64)
        begin, end = first * self.low_bits, (first + count) * self.low_bits
        bits = np.unpackbits(self.low[begin // 8:-(-end // 8)], bitorder="little")[begin % 8:begin % 8 + end - begin]
        return bits.reshape(count, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, first: int, count: int = 1) -> np.ndarray:
        """Values ``first`` to ``first + count - 1``: from the sample before them, by the set bits that follow."""
        sample = first // SAMPLE
        after = -(-(first + count) // SAMPLE)
        start = int(self.samples[sample])
        stop = int(self.samples[after]) + 1 if after < len(self.samples) else len(self.high) * 8
        bits = np.unpackbits(self.high[start // 8:-(-stop // 8)], bitorder="little")[start % 8:]
        at = first - sample * SAMPLE
        places = np.flatnonzero(bits)[at:at + count] + start
        return ((places - np.arange(first, first + count)) << self.low_bits) + self._lows(first, count)

    def size(self) -> int:
        return self.high.nbytes + self.low.nbytes + self.samples.nbytes


class Writer:
    """Writes one file; only the number of ids of each document is kept until the end."""

    def __init__(self, folder: str, width: int):
        self.folder, self.name, self._width = folder, attempt_name(".ids"), width
        self._out, self._docs, self._ends, self.n_ids = create(folder, self.name), [], [0], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        values = np.frombuffer(ids, "<u4")
        self._out.write(values.astype("<u2").tobytes() if self._width == 2 else ids)
        self.n_ids += len(values)
        self._ends.append(self.n_ids)
        self._docs.append(doc_id)

    def close(self) -> None:
        bounds = EliasFano.of(np.array(self._ends))
        nulls = sum(d is None for d in self._docs)  # they come first
        docs = np.array([d for d in self._docs if d is not None], "<i8").tobytes()
        parts = [bounds.high.tobytes(), bounds.low.tobytes(), bounds.samples.astype("<u4").tobytes(), docs]
        for part in parts:
            self._out.write(part)
        self._out.write(_TRAILER.pack(_MAGIC, self._width, bounds.low_bits, len(self._docs), nulls, *map(len, parts)))
        self._out.close()


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, folder: str, name: str):
        self._file = open_file(folder, name)
        size = self._file.size()
        magic, self._width, low_bits, self.n_docs, nulls, high, low, samples, docs = _TRAILER.unpack(
            self._file.read_at(_TRAILER.size, size - _TRAILER.size))
        if magic != _MAGIC:
            raise ValueError(f"{folder}/{name} is not a token file")
        at = size - _TRAILER.size - high - low - samples - docs
        read = lambda n, kind: np.frombuffer(self._file.read(n), kind)
        self._file.seek(at)
        self.bounds = EliasFano(self.n_docs + 1, low_bits, read(high, np.uint8), read(low, np.uint8), read(samples, "<u4"))
        self.docs = [None] * nulls + read(docs, "<i8").tolist()

    def ids(self, start: int, stop: int) -> np.ndarray:
        data = self._file.read_at((stop - start) * self._width, start * self._width)
        return np.frombuffer(data, f"<u{self._width}").astype("<u4")

    def documents(self, at_once: int = 4096) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(document id, its first id's place, its ids), in order; ids are read in runs of some megabytes."""
        for first in range(0, self.n_docs, at_once):
            count = min(at_once, self.n_docs - first)
            ends = self.bounds.select(first, count + 1)
            run = 0
            while run < count:
                stop = max(run + 1, int(np.searchsorted(ends, ends[run] + _READ // self._width, "right")) - 1)
                ids = self.ids(int(ends[run]), int(ends[stop]))
                for i in range(run, stop):
                    yield self.docs[first + i], int(ends[i]), ids[ends[i] - ends[run]:ends[i + 1] - ends[run]]
                run = stop


def write(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """Write the token files of ``docs``; returns their list: ``part, name, n_docs, n_ids, base`` (ids before the file)."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    top = max([*rules["model"]["vocab"].values(), *(t["id"] for t in rules.get("added_tokens", []))])
    width = 2 if top < 1 << 16 else 4
    # Texts are dealt, not ids: they are smaller, and Spark runs what it takes the ranges from twice.
    keyed = docs.select("doc_id", F.xxhash64("text").alias("_content"), "text")
    ordered = keyed.repartitionByRange("doc_id", "_content").sortWithinPartitions("doc_id", "_content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, end, writer, n = pieces(path), struct.pack("<I", END), None, 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                writer = writer or Writer(folder, width)
                writer.add(doc_id, own.text_ids(text.as_py() or "") + end)
                n += 1
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "name": [writer.name],
                                              "n_docs": [n], "n_ids": [writer.n_ids]})

    listed = stored(ordered.select("doc_id", "text").mapInArrow(run, "part long, name string, n_docs long, n_ids long"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return listed.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def read(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """One row per document of the listed files: ``doc_id, start, n_tokens, ids_crc32``; a file is a task's share."""
    n = files.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column("name").to_pylist(), batch.column("base").to_pylist()):
                rows = [(d, base + start, len(ids), zlib.crc32(ids.tobytes())) for d, start, ids in Reader(folder, name).documents()]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    dealt = files.select("part", "name", "base").repartitionByRange(max(n, 1), "part")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Write ``docs`` and read them back."""
    folder = shared_folder(docs.sparkSession, "tokens")
    return read(docs.sparkSession, write(docs, path, folder), folder)
