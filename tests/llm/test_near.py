import random
import re
from itertools import combinations

import numpy as np
import pytest
from faunagrid.llm import near
from faunagrid.llm.components import components
from faunagrid.llm.registry import oracle_sql
from pyspark.sql import functions as F

from tests.oracle import assert_same, tables

SF = "/root/testdata/sf0.01"


def set_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def by_hand(rows):
    """doc to (size, component), by comparing every pair."""
    sets = [(doc, set_of(text)) for doc, text in rows if doc is not None]
    parent = {doc: doc for doc, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, s), (b, t) in combinations(sets, 2):
        both = len(s & t)
        if s and t and 100 * both >= 80 * (len(s) + len(t) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {doc: (len(s), root(doc)) for doc, s in sets}


def check(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n string")
    got = near.link(df).collect()
    assert len(got) == len(rows)
    expected = by_hand(rows)
    assert {r.id: (r.n_shingles, r.component_id) for r in got if r.id is not None} == expected
    assert all(r.component_id is None for r in got if r.id is None)


def test_query_matches_sql(spark):
    assert_same(tables(SF), near.op4_ngram_jaccard_join(spark, SF).toPandas(), oracle_sql()["op4_ngram_jaccard_join"])


def test_edges(spark):
    rows = [(5, None), (4, ""), (3, " \t\n"), (2, "one two"), (1, "ONE\ttwo"), (9, "one two three four five"), (8, "One two THREE four five"), (None, "one two"), (20, "É a b c d"), (21, "é a b c d"), (30, "w " * 30000), (31, "w " * 9)]
    check(spark, rows)
    assert near.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("stars", [near.STAR_KEYS, 1])
def test_random_edits_by_hand(spark, monkeypatch, stars):
    """Chains of edits, shared passages, and pairs on either side of the threshold.

    With one star key most links are left to the prefix tokens, in small blocks, with joins instead of bits.
    """
    monkeypatch.setattr(near, "STAR_KEYS", stars)
    if stars == 1:
        monkeypatch.setattr(near, "STAR_ROWS", 14)
        monkeypatch.setattr(near, "BLOCK", 8)
        monkeypatch.setattr(near, "SMALL", 4)
        monkeypatch.setattr(near, "MOST_BITS", 0)
    rng = random.Random(stars)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts = []
    for _ in range(12):
        words = rng.choices(vocabulary, k=rng.randrange(20, 120))
        for _ in range(rng.randrange(1, 14)):
            texts.append(" ".join(words))
            words = words[:]
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    texts += [" ".join(rng.choices(vocabulary, k=30)) + " " + passage + " " + " ".join(rng.choices(vocabulary, k=30)) for _ in range(30)]
    rng.shuffle(texts)
    check(spark, [*enumerate(texts, 1)])


def test_trees_lose_no_pair():
    """Traversal gives every pair of different groups that is alike, whatever it leaves out."""
    rng = np.random.default_rng(1)
    members, sets = [], {}
    for doc in range(150):
        if doc % 3 or not sets:
            tokens = rng.integers(0, 1 << 63, rng.integers(5, 400)).astype(np.uint64)
        else:
            tokens = sets[doc - 1][rng.random(len(sets[doc - 1])) > 0.1]
        sets[doc] = np.unique(tokens)
        members.append(near.Member(doc, doc % 7, len(sets[doc]), 0, near.bitmap(sets[doc])))
    root = near.tree(members)
    found = {*near.candidates(root, root)}
    a, b = near.tree(members[:70]), near.tree(members[70:])
    across = {*near.candidates(a, b)}
    true = {(y, x) for x, y in combinations(range(150), 2) if x % 7 != y % 7 and near.alike(sets[x], sets[y])}
    assert true and true <= found and len(found) < 10 * len(true)
    assert {(y, x) for y, x in true if x < 70 <= y} <= across


def test_most_shared_is_a_bound():
    rng = np.random.default_rng(3)
    for _ in range(300):
        pool = np.unique(rng.integers(0, 1 << 63, 900).astype(np.uint64))
        a, b = (np.sort(rng.choice(pool, rng.integers(1, 600), replace=False)) for _ in range(2))
        x, y = (near.Member(0, 0, len(t), 0, near.bitmap(t)) for t in (a, b))
        assert near.most_shared(x, y) >= len(np.intersect1d(a, b))


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, x) for x in range(1001, 1400)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_large_group_of_near_copies(spark):
    base = [f"t{i}" for i in range(100)]
    rows = []
    for i in range(1500):
        words = base[:]
        words[i % 100] = f"own{i}"
        rows.append((i, " ".join(words)))
    got = near.link(spark.createDataFrame(rows, "doc_id long, text string")).agg(F.count_distinct("component_id"), F.min("component_id")).first()
    assert tuple(got) == (1, 0)


def test_leaders_take_a_group_without_its_pairs():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    members = []
    for doc in range(900):
        tokens = np.unique(np.concatenate((base[rng.random(300) > 0.03], rng.integers(0, 1 << 63, 5).astype(np.uint64))))
        members.append(near.Member(doc, doc, len(tokens), 0, near.bitmap(tokens)))
    pairs = {*near.led(members)}
    assert len(pairs) == 899 and {b for _, b in pairs} == {0}


def test_links_of_a_group_are_as_few_as_its_documents():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    members, sets = [], {}
    for doc in range(400):
        tokens = np.unique(np.concatenate((base[rng.random(200) > rng.choice([0.02, 0.12])], rng.integers(0, 1 << 63, 4).astype(np.uint64))))
        sets[doc] = tokens
        members.append(near.Member(doc, doc - doc % 3, len(tokens), 0, near.bitmap(tokens), tokens))
    root = near.tree(members)
    inside = [*near.links_of(root, root)]
    a, b = near.tree(members[:150]), near.tree(members[150:])
    across = [*near.links_of(a, b)]
    assert all(near.alike(sets[x], sets[y]) for x, y in inside + across) and len(inside) < 400 and len(across) < 400

    def classes(edges):
        parent = {m.id: m.comp for m in members}

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for x, y in edges:
            x, y = top(x), top(y)
            parent[max(x, y)] = min(x, y)
        return {x: top(x) for x in parent}

    true = [(y, x) for x, y in combinations(range(400), 2) if near.alike(sets[x], sets[y])]
    assert len(true) > 10_000 and classes(inside) == classes(true)
    assert classes(across) == classes([(y, x) for y, x in true if x < 150 <= y])


def test_a_token_of_several_large_groups(spark, monkeypatch):
    """Documents of two linked groups and a few others share their rarest token, in more than one block."""
    monkeypatch.setattr(near, "BLOCK", 8)
    monkeypatch.setattr(near, "SMALL", 8)
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    texts = []
    for name in "xy":
        for i in range(40):
            body = words("common", 30) + words(name, 60)
            body[40 + i % 45] = f"own{i}"
            texts.append(" ".join(body))
    texts += [" ".join(words("common", 30) + words(f"z{i}", 20)) for i in range(10)]
    check(spark, [*enumerate(texts)])


def test_text_ids(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(50)) for x in "ab")
    df = spark.createDataFrame([("z", a), ("m", a + " more"), ("k", b), (None, a), ("k2", None)], "doc_id string, text string")
    got = {r.id: r.component_id for r in near.link(df).collect()}
    assert got == {"z": "m", "m": "m", "k": "k", "k2": "k2", None: None}
