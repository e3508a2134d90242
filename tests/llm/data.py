"""Small tables with the cases that every operator must bear."""

import random

from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, _id long, kind string, _row int"
PAGES = "page_id long, url string, html string, _payload string, _terms int"


def words(seed, n):
    r = random.Random(seed)
    return [r.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu".split()) + str(r.randint(0, 30)) for _ in range(n)]


def text(seed, n, per_line=12):
    w = words(seed, n)
    return "\n".join(" ".join(w[i:i + per_line]) for i in range(0, n, per_line))


def edited(base, places, seed=0):
    w = base.split(" ")
    r = random.Random(seed)
    for _ in range(places):
        w[r.randrange(len(w))] = "changed%d" % r.randrange(10**6)
    return " ".join(w)


def documents(spark, rows):
    full = [(*(row + (None,) * (5 - len(row))), 7, "clash", 3) for row in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def awkward():
    """(doc_id, text, lang, source, n_chars): NULLs everywhere, empty, one word, repeated rows, equal ids, a long text."""
    long = text(3, 6000)
    return [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 3), (4, "word", "en", "b", 4),
            (5, text(5, 80), "en", "a", 1), (5, text(5, 80), "en", "a", 1), (5, text(6, 80), "de", "a", 1),
            (None, text(7, 90), "fr", None, None), (None, None, None, None, None), (8, long, "en", "a", len(long)),
            (9, "!!! 123 *** ###", "en", "b", 15), (10, "\u00e9t\u00e9 \u6f22\u5b57 \U0001f600 " + text(9, 60), "fr", "b", 9),
            (11, text(5, 80), "en", "c", 1)]


def pages(spark, rows):
    return spark.createDataFrame([(*row, "clash", 1) for row in rows], PAGES)


def empty(spark, schema):
    return spark.createDataFrame([], T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
