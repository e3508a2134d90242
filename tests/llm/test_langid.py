import random

import numpy as np
import pyarrow as pa

from lodework.llm import langid
from tests.llm import data

SYLLABLES = {"en": "th er on an re he in ed nd ha".split(), "de": "en er ch ei ie sch ung ge ver \u00e4".split(),
             "fr": "es le de re ai que ou \u00e9 \u00e8 eau".split(), "es": "os as ci\u00f3n ar do la el \u00f1 \u00ed mente".split()}


def sentence(lang, seed, n=40):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 3))) for _ in range(n))


def test_held_out_accuracy_and_awkward_rows(spark):
    rows = [(i, sentence(lang, i), lang, "s", 0) for i in range(400) for lang in [list(SYLLABLES)[i % 4]]]
    docs = data.documents(spark, rows + [(1000, None, "en"), (1001, "", "en"), (1002, "123 !?", "en"), (None, sentence("fr", 1), "fr"),
                                         (None, None, None), (1, sentence("en", 0, 5000), None), (1, sentence("en", 0, 5000), None)])
    found = langid.identify(docs).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in found if r.held_out and r.doc_id in truth and r.doc_id != 1]
    assert len(held) > 50 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    odd = [r for r in found if r.doc_id in (1000, 1001, 1002)]
    assert len(odd) == 3 and all(r.lang_pred == "und" and r.score == 0 for r in odd)
    assert all(0 <= r.score <= 1 for r in found) and len(found) == docs.count()
    assert {r.lang_pred for r in found if r.doc_id is None} == {"fr", "und"}
    kept = langid.clean(docs)
    assert kept.columns == docs.columns and kept.count() >= 400


def test_no_labels_and_empty_table(spark):
    docs = data.documents(spark, [(1, "some text", None), (2, "other", None)])
    assert {r.lang_pred for r in langid.identify(docs).collect()} == {"und"}
    assert langid.identify(data.empty(spark, data.DOCUMENTS)).count() == 0
    one = data.documents(spark, [(i, "some text", "xx") for i in range(9)])
    assert {r.lang_pred for r in langid.identify(one).collect()} == {"xx"}


def test_codewords_are_apart():
    for n in range(2, 20):
        code = langid.codewords(n)
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert code.shape[0] == n and apart >= min(3, 2 ** (n - 2)) and np.abs(code).min() == 1


def test_margins_by_brute_force():
    model = langid.Model(["a", "b"], np.random.default_rng(1).integers(1, 99, (2, langid.FEATURES)))
    texts = ["", "x", "Some text, IN all", "\u00e9t\u00e9 " * 50, "tail end"]

    def margin(text):
        folded, total, n = langid._FOLD[np.frombuffer(text.encode(), np.uint8)].tolist(), 0.0, 0
        for order in langid._ORDERS:
            for i in range(len(folded) - order + 1):
                gram = 0
                for b in folded[i:i + order]:
                    gram = (gram << 8 | b) & 0xFFFFFFFF
                total += float(model.bits[((gram + order) * 2654435761 & 0xFFFFFFFF) >> 18, 0])
                n += 1
        return total / max(n, 1) ** 0.5

    assert np.allclose(model.margins(pa.array(texts))[:, 0], [margin(t) for t in texts], atol=1e-3)
