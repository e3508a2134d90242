import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lodework.llm import tokenfiles, warc
from lodework.llm.files import shared_folder
from tests.llm import data

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [1, 2, 5, 257, 3000])
def test_elias_fano(n):
    r = np.random.default_rng(n)
    for values in (np.sort(r.integers(0, 50, n)), np.cumsum(r.integers(0, 5000, n)), np.zeros(n, int), np.arange(n)):
        packed = tokenfiles.EliasFano.of(values)
        assert (packed.select(0, n) == values).all()
        for i in r.integers(0, n, 20).tolist():
            count = min(300, n - i)
            assert (packed.select(i, count) == values[i:i + count]).all()
    if n > 1000:
        assert tokenfiles.EliasFano.of(np.cumsum(r.integers(0, 5000, n))).size() < 2.2 * n


def test_token_files_round_trip(spark):
    rows = data.awkward()
    docs = data.documents(spark, rows)
    library, start, expected = Tokenizer.from_file(BYTE), 0, []
    found = tokenfiles.round_trip(docs, BYTE).orderBy("start").collect()
    by_id = Counter()
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [0]
        by_id[(r[0], len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == by_id
    for r in found:
        assert r.start == start
        start += r.n_tokens
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0)) and not expected
    assert tokenfiles.round_trip(data.empty(spark, data.DOCUMENTS), BYTE).count() == 0


def pages():
    body = "<p>" + "x" * 120 + "</p>"
    return [(1, "http://a/1", body), (2, "http://a/2", body), (2, "http://a/2", body), (0, "http://a/0", body), (0, "http://a/0", body),
            (3, None, "short"), (4, "http://a/4", "short"), (5, "u", None), (6, "u\r\nx: y", ""), (None, "n", body), (None, None, None),
            (7, "http://a/7", data.text(1, 60_000)), (8, "http://a/8", "\x1f\u008b\x08 \u00e9" * 50)]


@pytest.mark.parametrize("range_bytes", [64, 5000, 1 << 23])
def test_archives_by_ranges(spark, range_bytes):
    import hashlib

    folder = shared_folder(spark, "warc-test")
    found = warc.read(warc.write(data.pages(spark, pages()), folder), folder, range_bytes).collect()
    expected = Counter()
    for page_id, _, html in pages():
        payload = (html or "").encode()
        revisit = len(payload) >= 100 and payload.startswith(b"<p>") and page_id != 0
        expected[(page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response",
                  0 if revisit else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == expected
    assert {bytes(r.payload) for r in found if r.page_id == 8} == {pages()[-1][2].encode()}
    assert {r.url for r in found if r.page_id == 6} == {"u%0D%0Ax: y"}


def test_no_pages(spark):
    assert warc.round_trip(spark, data.empty(spark, data.PAGES)).count() == 0
