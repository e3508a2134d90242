import hashlib
import math
import random
import re
import zlib

import numpy as np

from lodework.llm import importance
from tests.llm import data

ITEMS = "item_id string, text string, weight int"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def buckets(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def expected(docs, items):
    def counts(texts):
        c = [0] * 10000
        for t in texts:
            for b in buckets(t):
                c[b] += 1
        return c
    s, t = counts(d[1] for d in docs), counts(i[1] for i in items)
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows = []
    for doc_id, text, *_ in docs:
        own = buckets(text)
        weight = sum(gain[b] for b in own)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), weight, score, len(words(text))])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): i + 1 for i, r in enumerate(able[:5 * len(able) // 100])}
    return sorted((str(r[0]), *r[1:4], ranks.get(id(r))) for r in rows)


def test_equals_brute_force(spark):
    docs = data.awkward() + [(100 + i, data.text(i, 10 + i), "en", "s", 0) for i in range(150)]
    docs += [(500, "X" * 1000 + " " + "y" * 96 + " " + "z" * 97 + " TailÉ é", None, None, 0), (501, "a" * 250_000 + " b c", None, None, 0)]
    items = [("a", data.text(3, 60), 1), ("b", None, 1), (None, "X" * 1000, 1), ("c", "", 1)]
    found = importance.resample(data.documents(spark, docs), spark.createDataFrame(items, ITEMS)).collect()
    got = sorted((str(r.doc_id), r.n_features, r.weight, r.score, r["rank"]) for r in found)
    want = expected(docs, items)
    # Equal rows of one id may stand in either order.
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert sorted(g[4] for g in got if g[4]) == sorted(w[4] for w in want if w[4])
    assert {g[4]: g[:4] for g in got if g[4]} == {w[4]: w[:4] for w in want if w[4]}


def test_checksums_of_any_length():
    r = random.Random(5)
    held = bytes(r.randrange(256) for _ in range(300_000))
    spans = [(0, 1), (5, 95), (5, 96), (5, 97), (7, 96 * 2), (9, 96 * 8193 // 3), (1, 299_000)] + [(r.randrange(1000), r.randrange(1, 500)) for _ in range(300)]
    starts, lengths = map(np.array, zip(*spans))
    assert importance.checksums(np.frombuffer(held, np.uint8), starts, lengths).tolist() == [zlib.crc32(held[s:s + n]) for s, n in spans]


def test_empty_tables(spark):
    none = data.empty(spark, data.DOCUMENTS)
    items = data.empty(spark, ITEMS)
    assert importance.resample(none, items).count() == 0
    found = importance.resample(data.documents(spark, [(1, data.text(1, 40)), (2, None)]), items).collect()
    assert sorted((r.doc_id, r.n_features, r["rank"]) for r in found) == [(1, 117, None), (2, 0, None)]
