"""WARC archives: written by tasks, read back by byte ranges.

Every record is a gzip member of its own. The reader deals out byte ranges of the files;
a task looks for gzip's first bytes in its range, takes a place for a record's begin only
if the bytes there unpack to a WARC header, and owns the records that begin in its range,
reading past its end where the last one goes on. So a file is read by as many tasks as it
has ranges, without an index.

Pages with equal payloads of at least ``LEAST`` bytes are written once, as the response of
the least page id; the others are revisits that refer to it. A NULL html is an empty
payload; pages with a NULL id revisit a page with an id, and among themselves are all
responses; rows that repeat the least id are responses as well. An empty table makes no
archive; payloads of any length are streamed; extra columns do not matter.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodework.llm.common import stored
from lodework.llm.files import attempt_name, create, open_file, shared_folder

LEAST = 100
RANGE = 8 << 20
_READ = 1 << 18
_MAGIC = b"\x1f\x8b\x08"
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, packed. A revisit has no payload; length and digest are those of the page's."""
    revisit = refers_to is not None
    block = _HEAD if revisit else _HEAD + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` as archives in ``folder``; returns their list: ``name, size``."""
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("_payload"))
    own = own.withColumn("_digest", F.sha2("_payload", 256))
    long = own.filter(F.octet_length("_payload") >= LEAST)
    copied = stored(long.groupBy("_digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
                    .filter((F.col("_n") > 1) & F.col("_first").isNotNull()).drop("_n"), "copied-payloads")
    refers_to = F.when((F.col("page_id") > F.col("_first")) | F.col("page_id").isNull(), F.col("_first"))
    rows = own.join(copied, "_digest", "left").select("page_id", "url", "_payload", "_digest", refers_to.alias("_refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, size = None, attempt_name(".warc.gz"), 0
        for batch in batches:
            payloads = batch.column("_payload")
            rest = [batch.column(c).to_pylist() for c in ("page_id", "url", "_digest", "_refers_to")]
            for i, (page_id, url, digest, first) in enumerate(zip(*rest)):
                out = create(folder, name) if out is None else out
                packed = _record(page_id, url, payloads[i].as_py(), digest, first)
                out.write(packed)
                size += len(packed)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"name": [name], "size": [size]})

    return stored(rows.mapInArrow(run, "name string, size long"), "archives")


class _Window:
    """Bytes of a file from a moving place on."""

    def __init__(self, file, size: int):
        self._file, self._size, self.at, self._held = file, size, 0, b""

    def seek(self, at: int) -> None:
        skip = at - self.at
        self._held = self._held[skip:] if 0 <= skip <= len(self._held) else b""
        self.at = at

    def more(self) -> bool:
        """Hold another run of bytes; false at the end of the file."""
        begin = self.at + len(self._held)
        data = self._file.read_at(min(_READ, self._size - begin), begin) if begin < self._size else b""
        self._held += data
        return bool(data)

    def find(self, stop: int) -> int:
        """The next place before ``stop`` where gzip's first bytes stand, or -1."""
        while True:
            i = self._held.find(_MAGIC)
            if i >= 0:
                return self.at + i if self.at + i < stop else -1
            self.seek(max(self.at, self.at + len(self._held) - len(_MAGIC) + 1))
            if self.at >= stop or not self.more():
                return -1

    def member(self) -> tuple[bytes, int] | None:
        """The record that begins here and the place behind it; None if none does."""
        unpack, parts, at, valid = zlib.decompressobj(31), [], self.at, False
        fed = 0
        while True:
            if fed == len(self._held) and not self.more():
                return None
            piece = self._held[fed:fed + _READ]
            fed += len(piece)
            try:
                parts.append(unpack.decompress(piece))
            except zlib.error:
                return None
            if not valid:
                begun = b"".join(parts)[:7]
                if begun != b"WARC/1."[:len(begun)]:
                    return None
                valid = len(begun) == 7
            if unpack.eof:
                return b"".join(parts), at + fed - len(unpack.unused_data)


def records(file, size: int, begin: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of the records that begin in ``[begin, end)``."""
    window = _Window(file, size)
    window.seek(begin)
    while (at := window.find(end)) >= 0:
        window.seek(at)
        found = window.member()
        if found is None:
            window.seek(at + 1)
            continue
        record, after = found
        head, _, rest = record.partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield headers, rest[:int(headers["Content-Length"])]
        window.seek(after)


def _page(urn: str | None) -> int | None:
    place = urn and urn.removeprefix("<urn:page:").removesuffix(">")
    return None if not place or place == "None" else int(place)


def read(archives: DataFrame, folder: str, range_bytes: int = RANGE) -> DataFrame:
    """One row per record: ``page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to``.

    ``payload`` is NULL for revisits. Length and digest of responses are taken from the payload itself.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long")))
    ranges = archives.select("name", "size", starts.alias("begin"))
    n = ranges.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.to_pylist():
                rows, held = [], 0
                for headers, block in records(open_file(folder, one["name"]), one["size"], one["begin"], one["begin"] + range_bytes):
                    kind = headers["WARC-Type"]
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    rows.append((_page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), payload,
                                 int(headers["X-Payload-Length"]) if payload is None else len(payload),
                                 headers["WARC-Payload-Digest"].removeprefix("sha256:") if payload is None
                                 else hashlib.sha256(payload).hexdigest(), kind, _page(headers.get("WARC-Refers-To"))))
                    held += len(payload or b"")
                    if held > _READ * 16:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return ranges.repartitionByRange(max(n, 1), "name", "begin").mapInArrow(run, _SCHEMA)


_SCHEMA = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long")
_TYPES = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _TYPES)],
                                      names=[c.split()[0] for c in _SCHEMA.split(", ")])


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` and read the archives back."""
    folder = shared_folder(spark, "warc")
    return read(write(pages, folder), folder)
