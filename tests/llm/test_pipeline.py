"""The pipeline over a small folder, each stage against its brute force."""

import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lodework.llm.common import stored
from tests.llm import data
from tests.llm.test_decontaminate import judged
from tests.llm.test_jaccard import linked
from tests.llm.test_langid import SYLLABLES, sentence
from tests.llm.test_quality import base

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def folder_of(spark, folder):
    item = sentence("en", 4000, 30)
    rows = [(i, sentence(lang, i, 90), lang, f"host{i % 3}", 0) for i in range(120) for lang in [list(SYLLABLES)[i % 4]]]
    rows += [(200 + i, data.edited(sentence("en", 3, 120), i % 3, i), "en", "host1", 0) for i in range(12)]
    rows += [(300, sentence("en", 30, 60) + " " + item, "en", "host1", 0), (301, "too short", "en", "host1", 0), (302, None, None, None, None),
             (303, " ".join(["again and again"] * 60), "en", "host2", 0), (304, "1 2 3 4 5 6 7 " * 20, "en", "host2", 0),
             (305, " ".join(str(i) for i in range(80)), "en", "host2", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, item


def test_stages(spark, folder):
    rows, item = folder_of(spark, folder)
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), "test-stage")
        assert docs.columns == COLUMNS
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    by_rules = {r[0] for r in rows if (c := base(r[1]))[0] >= 50 and 2 * c[4] <= c[0]}
    assert set(kept["quality rules"]) == by_rules and 305 in by_rules
    assert set(kept["language id"]) == by_rules - {305}
    links = linked([(i, t) for i, t in sorted(kept["language id"].items())])
    assert set(kept["jaccard join"]) == {c for _, c, _ in links} and len(links) > len(kept["jaccard join"])
    clean = {i for i, t in kept["jaccard join"].items() if not judged(t, [(1, item)])[3]}
    assert set(kept["decontamination"]) == clean and 300 not in clean
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in found} == clean and len(found) == len(clean)
    for r in found:
        ids = library.encode(kept["decontamination"][r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
