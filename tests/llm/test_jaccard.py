from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lodework.llm import jaccard, shingles
from tests.llm import data


def grams(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked(rows):
    sets = [grams(r[1]) for r in rows]
    links, near = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while near[i] != i:
            i = near[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                near[max(top(i), top(j))] = min(top(i), top(j))
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[top(i)].append(rows[i][0])
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return Counter((rows[i][0], least[top(i)], links[i]) for i in range(len(rows)))


def corpus():
    rows = data.awkward()
    base = data.text(70, 200, 200)
    rows += [(100 + i, data.edited(base, i % 5, i), "en", "a", 0) for i in range(60)]
    rows += [(200 + i, base if i % 2 else base.upper(), "en", "a", 0) for i in range(20)]
    rows += [(300 + i, data.text(70, 60, 60) + " " + data.text(400 + i, 100, 100), "en", "a", 0) for i in range(40)]
    rows += [(400 + i, data.text(i // 2 + 800, 150, 150) + " tail" * (i % 2), "en", "b", 0) for i in range(30)]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    found = Counter(map(tuple, jaccard.join(data.documents(spark, rows)).collect()))
    assert found == linked(rows)


def test_large_buckets_are_split_and_compared_in_blocks(spark):
    rows = corpus()
    found = Counter(map(tuple, jaccard.join(data.documents(spark, rows), small=4, block=16, recall=0.9999).collect()))
    assert found == linked(rows)


def test_one_of_each_group_stays(spark):
    rows = corpus()
    docs = data.documents(spark, rows)
    kept = jaccard.clean(docs)
    groups = {(c, d is None) for d, c, n in linked(rows) if n}
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns
    assert all(sum(i == c for i in ids) == 1 for c, _ in groups if c is not None and c >= 100)


def test_shingles():
    tokens, bounds = shingles.sets(pa.array(["a b c d e f", None, "", "A  b\nc D e f", "a b", "ab", "a b c d e f a b c d e f"]))
    sizes = np.diff(bounds).tolist()
    assert sizes == [2, 0, 0, 2, 1, 1, 6]
    assert set(tokens[:2]) == set(tokens[bounds[3]:bounds[4]]) and set(tokens[:2]) <= set(tokens[bounds[6]:])
    assert tokens[bounds[4]] != tokens[bounds[5]]


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 7)], [(i, i + 1) for i in range(40)], []])
def test_components(spark, edges):
    found = jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()
    label = dict(map(tuple, found))
    assert len(found) == len(label) == len({x for e in edges for x in e})
    assert all(label[a] == label[b] for a, b in edges) and all(x in label.values() for x in {min(label[a], a) for a, _ in edges})


def test_runs_reach_the_recall():
    assert 1 - (1 - 0.8**4) ** jaccard.runs() >= 0.995


def test_empty_table(spark):
    assert jaccard.join(data.empty(spark, data.DOCUMENTS)).count() == 0


def template(n, seed=71):
    base = data.text(seed, 200, 200)
    return [(1000 + i, data.edited(base, 1, i), "en", "a", 0) for i in range(n)]


def dealt_rows(monkeypatch, spark, rows):
    counts, blocks = [], jaccard._blocks

    def counted(members, block):
        made = blocks(members, block)
        counts.append(made.filter("block_b > 0").count())
        return made

    monkeypatch.setattr(jaccard, "_blocks", counted)
    found = Counter(map(tuple, jaccard.join(data.documents(spark, rows), small=4, block=16, recall=0.9).collect()))
    monkeypatch.setattr(jaccard, "_blocks", blocks)
    return counts[0], found


def test_a_templates_variants_are_packed(spark, monkeypatch):
    """Rows dealt to blocks grow with the variants, not with their square, and every link is counted."""
    few, found = dealt_rows(monkeypatch, spark, template(200))
    assert found == linked(template(200))
    many, found = dealt_rows(monkeypatch, spark, template(800))
    assert all(n == 799 and c == 1000 for _, c, n in found) and len(found) == 800
    assert many <= 6 * max(few, 100)


def test_balls_beside_looser_copies_and_other_texts(spark):
    """Two templates that share half of their words, tight and loose variants of both, and copies of variants."""
    one, two = data.text(72, 200, 200), data.text(72, 200, 200)[:600] + " " + data.text(73, 120, 120)
    rows = [(2000 + i, data.edited(base, 1 + 3 * (i % 4 == 0), i), "en", "a", 0) for base, first in ((one, 0), (two, 150)) for i in range(first, first + 150)]
    rows += [(3000 + i, rows[i][1], "en", "b", 0) for i in range(0, 60, 3)]
    found = Counter(map(tuple, jaccard.join(data.documents(spark, rows), small=4, block=16, recall=0.99999).collect()))
    assert found == linked(rows)


def test_of_equal_rows_the_first_by_its_other_columns_stays(spark):
    rows = [(1, data.text(74, 60), lang, source, 0) for lang in ("fr", "en", None) for source in ("b", "a")]
    kept = [tuple(jaccard.clean(data.documents(spark, order)).collect()[0])[2:4] for order in (rows, rows[::-1])]
    assert kept[0] == kept[1]
