import random
import zlib

import numpy as np

from lodework.llm import crf
from tests.llm import data

LABELS = "doc_id long, quality int, toxic int, score double"


def paths(scores, first, follow, start):
    """Probability of good per line by adding up all label sequences of each document."""
    out, cuts = [], [i for i, f in enumerate(first) if f] + [len(first)]
    for a, b in zip(cuts, cuts[1:]):
        total, good = 0.0, np.zeros(b - a)
        for code in range(2 ** (b - a)):
            y = [(code >> i) & 1 for i in range(b - a)]
            w = np.exp(start[y[0]] + sum(s for s, on in zip(scores[a:b], y) if on) + sum(follow[p, q] for p, q in zip(y, y[1:])))
            total += w
            good += w * np.array(y)
        out += list(good / total)
    return out


def test_marginals_equal_all_paths():
    r = np.random.default_rng(1)
    for sizes in ([1], [3, 1, 5, 2, 9, 1, 1, 7], [2] * 30):
        n = sum(sizes)
        first = np.zeros(n, bool)
        first[np.cumsum([0, *sizes[:-1]])] = True
        scores, follow, start = r.normal(size=n), r.normal(size=(2, 2)), r.normal(size=2)
        assert np.allclose(crf.marginals(scores, first, follow, start)[0][:, 1], paths(scores, first, follow, start))


def test_measures_of_lines():
    texts = ["one two two\n\nONE! 12\none two two", "", "été b", " \n\t"]
    parts = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, parts)])
    measures, text, chars = crf.lines(np.frombuffer(b"".join(parts), np.uint8), bounds)
    assert text.tolist() == [0, 0, 0, 2] and chars.tolist() == [12, 8, 11, 5]
    distinct, same, twin = measures[:, -3], measures[:, -2], measures[:, -1]
    assert np.allclose(distinct, [2 / 3, 1, 2 / 3, 1]) and np.allclose(same, [1 / 3, 0, 1 / 3, 0]) and twin.tolist() == [1, 0, 1, 0]
    assert np.allclose(measures[1, :4], [0, 3 / 8, 2 / 8, 2 / 8])


def good(i):
    return data.text(i, 30 + i % 50)


def bad(i):
    r = random.Random(i)
    return "\n".join(" ".join(w + r.choice(["###", "$$$", "!!"]) for w in line.split(" ")) for line in data.text(i, 40).split("\n"))


def test_held_out_accuracy_and_awkward_rows(spark):
    rows = [(i, bad(i) if i % 5 == 1 or i % 7 == 1 else good(i), "en", "s", 0) for i in range(600)]
    labels = spark.createDataFrame([(i, 0 if i % 5 == 1 or i % 7 == 1 else 1, 0, 0.5) for i in range(500)]
                                   + [(None, 1, 0, 0.5), (3, 0, 0, 0.1), (4, None, 0, 0.2), (5, 7, 1, 0.2)], LABELS)
    extra = [(1000, None), (1001, ""), (1002, " \n\t\n"), (None, good(1)), (None, None), (9, good(9)), (2000, "\n".join([good(7)] * 3000))]
    docs = data.documents(spark, rows + extra)
    found = crf.score(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    truth = {i: 0 if i % 5 == 1 or i % 7 == 1 else 1 for i in range(600)}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert len(held) > 80 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(r.score == 0 for r in found if r.doc_id in (1000, 1001, 1002))
    assert [r.score > 0.3 for r in found if r.doc_id == 2000] == [True]


def test_a_score_reads_the_text_alone(spark):
    labels = spark.createDataFrame([(i, int(i % 2), 0, 0.0) for i in range(60)], LABELS)
    docs = [(i, good(i) if i % 2 else bad(i)) for i in range(60)]
    one = {r.doc_id: r.score for r in crf.score(data.documents(spark, docs + [(900, good(3), "en", "a"), (901, good(3), "de", "b")]), labels).collect()}
    assert one[900] == one[901] == one[3]


def test_no_labels_and_empty_tables(spark):
    docs = data.documents(spark, data.awkward())
    none = data.empty(spark, LABELS)
    assert {r.score for r in crf.score(docs, none).collect()} == {0.0, 0.5}
    one = spark.createDataFrame([(1, 1, 0, 0.0), (5, 1, 0, 0.0)], LABELS)
    assert {r.score for r in crf.score(docs, one).collect()} == {0.0, 0.5}
    assert crf.score(data.empty(spark, data.DOCUMENTS), one).count() == 0
