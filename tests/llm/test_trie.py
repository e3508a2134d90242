import hashlib
import math
import random
import re
import zlib

import pytest

from lodework.llm import trie
from tests.llm import data

SCHEMA = "conv_id long, turn long, role string, text string, name string, depth int, parent int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash", 5, 6) for r in rows], SCHEMA)


def expected(rows):
    """Every prefix of every rebuilt conversation, by the contract's words."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = {}
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        children = sum(len(n) == len(node) + 1 for n in below)
        leaves = sum(not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in below) for n in below)
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out[min(convs), len(node)] = (parent, len(convs), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def check(spark, rows):
    found = trie.trie(conversations(spark, rows)).collect()
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in found}
    assert len(got) == len(found)
    assert got == expected(rows)


def made(seed, n, deepest):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(1, deepest)):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["hi there", "ok", "", "a\tb\nc  d"])))
    return rows


def test_equals_brute_force(spark):
    rows = made(1, 90, 7) + made(2, 5, 40) + [(c, 0, "user", "hello you") for c in range(200, 260)]
    rows += [(300, None, None, None), (300, None, None, "x"), (300, 1, "user", None), (300, 1, "user", None), (None, 1, "user", "lost"),
             (301, 3, "u", "word " * 3000), (40, 0, "late", "second rows of one turn"), (-7, 0, "user", "hi"), (-20, 0, "user", "hi")]
    check(spark, rows)


def test_long_conversations_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 4)
    rows = [(c, t, "user", f"turn {t % 3} {'x' * (c > 2 and t > 40)}") for c in range(4) for t in range(70 + c)] + made(3, 25, 6)
    check(spark, rows)


def test_empty_table(spark):
    assert trie.trie(data.empty(spark, SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 21])
def test_names_tell_prefixes_apart(n):
    turns = [bytes([i]) * 16 for i in range(n)]
    assert len(set(trie._named(trie.ROOT, turns))) == n
    assert trie._named(trie.ROOT, turns)[:n - 1] == trie._named(trie.ROOT, turns[:-1])
    other = trie._named(trie.ROOT, [b"other" + bytes(11)] + turns[1:])
    assert not set(other) & set(trie._named(trie.ROOT, turns))
