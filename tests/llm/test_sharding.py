import zlib
from collections import Counter, defaultdict

import pytest

from lodework.llm import sharding
from tests.llm import data


def test_differencing():
    weights = [8, 7, 6, 5, 4]
    sums, places = sharding.difference([[0, w] for w in weights])
    assert sums == [14, 16]
    total = Counter()
    for w, to in zip(weights, places):
        total[to[1]] += w
    assert [total[0], total[1]] == sums


@pytest.mark.parametrize("options", [{}, {"shards": 3, "part": 5, "bucket_rows": 4}])
def test_shards(spark, options):
    rows = [r for r in data.awkward() if r[0] != 8] + [(100 + i, data.text(i % 90, 10 + i % 37), "en", "a", 0) for i in range(300)]
    found = sharding.shard(data.documents(spark, rows), **options).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots, sizes, of_text = defaultdict(list), Counter(), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        of_text[(r.text_crc32, r.size)].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())
    assert set(slots) <= set(range(options.get("shards", 16)))
    if options:
        assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values())


@pytest.mark.parametrize("share", [0.05, 1 / 3])
def test_parts_balance_beside_large_groups(spark, share):
    weights = [200 + i * 7919 % 3000 for i in range(20_000)]
    weights += [int(sum(weights) * share / (1 - share))]
    groups = spark.createDataFrame(list(enumerate(weights)), "id long, bytes long")
    found = {r.id: r.shard for r in sharding.assign(groups).collect()}
    assert sorted(found) == list(range(len(weights)))
    sums = Counter()
    for i, w in enumerate(weights):
        sums[found[i]] += w
    whole, _ = sharding.difference([[0] * 15 + [w] for w in sorted(weights, reverse=True)])
    assert max(sums.values()) <= 1.001 * whole[-1] and min(sums.values()) >= 0.999 * whole[0]


def test_bundles():
    weights = sorted([1 + i * 31 % 97 for i in range(5000)] + [4000, 90_000], reverse=True)
    places = sharding.bundle(weights, 4000)
    sums = Counter()
    for w, k in zip(weights, places):
        sums[k] += w
    assert sorted(sums) == list(range(len(sums))) and len(sums) <= 2 * sum(weights) / 4000 + 64
    assert sums[0] == 90_000 and all(s <= 4000 for k, s in sums.items() if k)


def test_empty_table(spark):
    assert sharding.shard(data.empty(spark, data.DOCUMENTS)).count() == 0
