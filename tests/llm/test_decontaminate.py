import re
from collections import Counter

from lodework.llm import decontaminate
from tests.llm import data

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def judged(text, items):
    w, hit, held = words(text), set(), set()
    for item, its in items:
        v = words(its)
        n = min(13, len(v))
        windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                held.add("" if item is None else str(item))
    return len(w), len(hit), tuple(sorted(held)), bool(hit) and 20 * len(hit) >= len(w)


def test_against_brute_force(spark):
    long, short, two = data.text(50, 40), "Only Six words, are in this", "tiny pair"
    items = [(1, long), (2, short), (10, two), (3, "one"), (4, None), (5, " .,! "), (None, data.text(51, 13)), (2, data.text(52, 20)),
             (7, long), (8, "\u00c9T\u00c9 \u00e9t\u00e9 caf\u00e9 na\u00efve words in a short row")]
    w = words(long)
    rows = data.awkward() + [
        (30, data.text(60, 30) + " " + long.upper() + " " + data.text(61, 30), "en", "a", 0),
        (31, " ".join(w[5:18]) + " " + data.text(62, 300), "en", "a", 0), (32, " ".join(w[5:17]) + " " + data.text(63, 20), "en", "a", 0),
        (33, "x " + short.replace(",", " -") + " y", "en", "a", 0), (34, "a tiny; pair here one", "en", "a", 0),
        (35, data.text(51, 13), "en", "a", 0), (36, (" ".join(w[:20]) + " stop ") * 5, "en", "a", 0),
        (37, "\u00c9T\u00c9 \u00e9t\u00e9 caf\u00e9 na\u00efve words in a short row", "fr", "a", 0), (38, long, "en", "a", 0), (38, long, "en", "a", 0)]
    docs = data.documents(spark, rows)
    benchmark = spark.createDataFrame([(*i, 1, "c") for i in items], "item_id long, text string, window int, hash string")
    found = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated)
                    for r in decontaminate.contamination(docs, benchmark).collect())
    assert found == Counter((r[0], *judged(r[1], items)) for r in rows)
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not judged(r[1], items)[3] for r in rows)


def test_empty_tables(spark):
    docs, none = data.documents(spark, data.awkward()), data.empty(spark, "item_id long, text string")
    assert decontaminate.contamination(docs, none).filter("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.contamination(data.empty(spark, data.DOCUMENTS), none).count() == 0
