import re
from collections import Counter

import duckdb

from lodework.llm import oracle, quality
from tests.llm import data

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def base(text):
    words = [w for w in SPACE.split(text or "") if w]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if SPACE.sub("", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_base_counts_by_brute_force(spark):
    again = data.text(1, 60)
    rows = data.awkward() + [(20, again + "\n" + again, "en", "a", 0), (21, "a b a b a b a b", "en", "a", 0),
                             (22, " ".join(["same"] * 200), "en", "a", 0)]
    found = quality.judge(data.documents(spark, rows)).collect()
    expected = Counter((r[0], *base(r[1])) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_frequent_lines(spark):
    menu = "Home | About Us |  Contact and all the other pages"
    rows = [(i, f"{data.text(i, 70)}\n{menu}", "en", "shop", 0) for i in range(8)]
    rows += [(100 + i, f"{data.text(500 + i, 55)}\n" + "\n".join([menu.upper()] * 60), "en", "shop", 0) for i in range(2)]
    rows += [(200 + i, f"{data.text(900, 70)}\nonly in copies", "en", "shop", 0) for i in range(9)]
    rows += [(300, f"{data.text(1000, 70)}\n{menu}", "en", "elsewhere", 0)]
    docs = data.documents(spark, rows)
    found = {r.doc_id: r for r in quality.judge(docs, max_documents=5, min_left=20).collect()}
    assert all(found[i].n_removed_lines == 1 and found[i].kept for i in range(8))
    assert all(found[100 + i].n_removed_lines == 60 and not found[100 + i].kept for i in range(2))
    assert all(found[200 + i].n_removed_lines == 0 and found[200 + i].kept for i in range(9))
    assert found[300].n_removed_lines == 0 and found[300].kept
    cleaned = {r.doc_id: r for r in quality.clean(docs, max_documents=5, min_left=20).collect()}
    assert set(cleaned) == {i for i, r in found.items() if r.kept}
    assert cleaned[0].text == data.text(0, 70) and cleaned[0].n_chars == len(cleaned[0].text) and cleaned[0].kind == "clash"
    assert cleaned[300].text.endswith(menu) and cleaned[200].text == rows[10][1]


def test_shared_lines_do_not_tell_documents_apart(spark):
    menus = [f"part {k} of the menu" for k in range(5)]
    rows = [(i, "\n".join(menus[:3] + [data.text(i, 60, 20)] + menus[3:]), "en", "short", 0) for i in range(30)]
    rows += [(100 + i, "\n".join([*menus, *menus[::-1], data.text(100 + i, 60, 60)]), "en", "one", 0) for i in range(25)]
    rows += [(200 + i, data.text(200 + i, 60, 20) + "\n" + "\n".join(menus), "en", "few", 0) for i in range(20)]
    found = {r.doc_id: r for r in quality.judge(data.documents(spark, rows)).collect()}
    assert all(found[i].n_removed_lines == 5 and found[i].kept for i in range(30))
    assert all(found[100 + i].n_removed_lines == 10 and found[100 + i].kept for i in range(25))
    assert all(found[200 + i].n_removed_lines == 0 and found[200 + i].kept for i in range(20))


def near_copies(first, n, host):
    base = [line.split(" ") for line in data.text(1, 240).split("\n")]
    rows = []
    for i in range(n):
        copy = [list(line) for line in base]
        copy[i % len(copy)][i % 12] = f"changed{i}"
        rows.append((first + i, "\n".join(" ".join(line) for line in copy), "en", host, 0))
    return rows


def test_result_equals_the_sql_where_lines_are_frequent(spark):
    menus = [f"item number {k} of a long menu" for k in range(5)]
    start = " ".join(menus[0].split(" ")[:4])
    rows = data.awkward() + near_copies(1000, 60, "near") + [(2000 + i, data.text(77, 80), "en", "copies", 0) for i in range(50)]
    # Body lines that begin like a menu line; a line held by as many documents as the limit, and by one more.
    rows += [(100 + i, "\n".join(menus[:3] + [f"{start} {data.text(i, 60, 20)}"] + menus[3:]), "en", "shop", 0) for i in range(100)]
    rows += [(3000 + i, f"{data.text(3000 + i, 60)}\nheld by twenty\n\tHELD  by twenty" + "\nheld by all \r" * (i % 2), "en", "limit", 0)
             for i in range(20)]
    rows += [(3100 + i, f"{data.text(3100 + i, 60)}\nheld by all\n{'held by all ' * 30}", "en", "limit", 0) for i in range(21)]
    # A NULL host and an empty one are two hosts.
    rows += [(4000 + i, f"{data.text(4000 + i, 60)}\nshared by two hosts", "en", None if i % 2 else "", 0) for i in range(30)]
    rows += [(5000 + i, f"{data.text(5000 + i, 60)}\nonly without a host", "en", None, 0) for i in range(25)]
    docs = data.documents(spark, rows)
    found = quality.judge(docs)
    duck = duckdb.connect()
    duck.register("frequent_docs", docs.toPandas())
    relation = duck.sql(oracle.QUALITY.replace("{documents}", "frequent_docs"))
    order = lambda r: tuple((v is None, v or 0) for v in r)
    names = found.columns
    want = sorted((tuple(None if v is None or v != v else int(v) for v in r) for r in relation.project(", ".join(names)).fetchall()), key=order)
    got = sorted((tuple(None if v is None else int(v) for v in r) for r in found.collect()), key=order)
    assert got == want
    lost = {r.doc_id: r.n_removed_lines for r in found.collect() if r.doc_id is not None}
    assert all(lost[100 + i] == 5 for i in range(100)) and all(lost[2000 + i] == 0 for i in range(50))
    assert all(lost[3100 + i] >= 1 for i in range(21)) and all(lost[4000 + i] == 0 for i in range(30))
    assert all(lost[5000 + i] == 1 for i in range(25)) and any(lost[1000 + i] for i in range(60))


def test_empty_table(spark):
    none = data.empty(spark, data.DOCUMENTS)
    assert quality.judge(none).count() == 0 and quality.clean(none).columns == none.columns
