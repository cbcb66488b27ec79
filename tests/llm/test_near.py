"""Near duplicates against brute force, and the search inside a task."""

from __future__ import annotations

import random

import numpy as np
import pytest
from texts import documents, words  # noqa: F401

from tallyhouse.llm import jaccard_join
from tallyhouse.llm.common import Scratch
from tallyhouse.llm.components import components


def sets_of(rows, width):
    result = {}
    for i, text in rows:
        w = [x.lower() for x in (text or "").encode().split()]
        if w:
            k = min(width, len(w))
            result[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
        else:
            result[i] = set()
    return result


def expected(rows, width, percent):
    sets = sets_of(rows, width)
    name = {i: i for i in sets}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    for i in sets:
        for j in sets:
            shared = len(sets[i] & sets[j])
            if i < j and shared and 100 * shared >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                name[max(a, b)] = min(a, b)
    return sorted((i, len(s), root(i)) for i, s in sets.items())


def corpus():
    draw = random.Random(5)
    rows, passage = [], " ".join(words(999, 60))
    for group in range(12):
        base = words(group, 80)
        for _ in range(draw.randrange(1, 9)):
            w = list(base)
            for _ in range(draw.randrange(0, 7)):
                w[draw.randrange(len(w))] = f"edit{draw.randrange(50)}"
            rows.append((len(rows), " ".join(w)))
    for i in range(40):  # a passage that many share, in texts that are short beside it
        rows.append((len(rows), passage + " " + " ".join(words(2000 + i, draw.randrange(1, 25)))))
    rows += [(500, None), (501, ""), (502, " \n "), (503, "One two"), (504, "one  TWO"), (505, "one"), (506, "one two three"), (507, "É è"), (508, "é è")]
    rows += [(600, " ".join(words(77, 6000))), (601, " ".join(words(77, 6000)[:-3]))]
    return rows


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80), (3, 50)])
def test_components(documents, width, percent):
    rows = corpus()
    got = jaccard_join.near_duplicates(documents(*rows), width=width, percent=percent)
    assert sorted(map(tuple, got.collect())) == expected(rows, width, percent)


def test_large_group_is_cut_into_blocks(documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 5)
    rows = corpus()
    got = jaccard_join.near_duplicates(documents(*rows), width=4, percent=60)
    assert sorted(map(tuple, got.collect())) == expected(rows, 4, 60)


def test_border_of_similarity(documents):
    shared = [f"s{i}" for i in range(88)]
    rows = [(1, " ".join(shared)), (2, " ".join(shared + [f"x{i}" for i in range(15)])), (3, " ".join(shared + [f"y{i}" for i in range(16)]))]
    # 85 shingles shared; unions of 100 and 101
    got = jaccard_join.near_duplicates(documents(*rows), width=4, percent=85)
    assert sorted(map(tuple, got.collect())) == [(1, 85, 1), (2, 100, 1), (3, 101, 3)]


def test_empty_table_and_repeated_rows(documents):
    none = documents((1, "a")).filter("doc_id > 5")
    assert jaccard_join.near_duplicates(none).collect() == []
    got = jaccard_join.near_duplicates(documents((2, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "z")))
    assert sorted((r[0] or 0, r[1], r[2] or 0) for r in got.collect()) == [(0, 1, 0), (0, 2, 2), (2, 2, 2), (2, 2, 2)]


def test_divide_skip_counts_like_brute_force():
    draw = random.Random(3)
    for _ in range(200):
        lists = [sorted(draw.sample(range(60), draw.randrange(0, 40))) for _ in range(draw.randrange(1, 30))]
        need = draw.randrange(1, 12)
        own = {m: need + draw.randrange(0, 3) for m in range(60)}
        banned = set(draw.sample(range(60), 10))
        got = jaccard_join.divide_skip(lists, need, lambda m: None if m in banned else own[m])
        assert got == [m for m in range(60) if m not in banned and sum(m in x for x in lists) >= own[m]]


def test_shares():
    draw = random.Random(4)
    for _ in range(100):
        a, b = (np.array(sorted(draw.sample(range(50), draw.randrange(0, 30))), np.uint64) for _ in range(2))
        assert jaccard_join.shares(a, b) == len(set(a.tolist()) & set(b.tolist()))


def test_components_of_a_graph(spark):
    draw = random.Random(6)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(120)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df, Scratch(spark, "test")).collect()}
    name = {x: x for e in edges for x in e if e[0] != e[1]}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            name[max(a, b)] = min(a, b)
    assert set(got) == set(name)
    groups = {}
    for x in name:
        groups.setdefault(root(x), set()).add(got[x])
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


class Recording(Scratch):
    """Keeps what is written, by name."""

    def __init__(self, spark, name):
        super().__init__(spark, name)
        self.tables = {}

    def write(self, df, name):
        self.tables[name] = super().write(df, name)
        return self.tables[name]


def test_blocks_of_a_large_component_hold_nothing_else(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 5)
    monkeypatch.setattr(jaccard_join, "LIST_BLOCKS", 3)
    shared = list(range(1000, 1020))
    rows = [(i, 21, sorted([*shared, 2000 + i])) for i in range(63)]  # 60 linked, 3 stragglers
    packed = [(i, n, bytearray(np.array(x, np.uint64).tobytes())) for i, n, x in rows]
    index = spark.createDataFrame([(i, n, p, p) for i, n, p in packed], "class long, n long, by_value binary, short binary")
    roots = spark.createDataFrame([(i, 0) for i in range(60)], "node long, root long")
    scratch = Recording(spark, "blocks")
    postings = scratch.write(jaccard_join._postings(index), "postings")
    links = jaccard_join._full_links(index, postings, roots, 80, scratch)
    joined = {x for r in links.select("a", "b").collect() for x in r}
    assert {60, 61, 62} <= joined
    held = {}
    for r in scratch.tables["blocks"].collect():
        held.setdefault(r["block"], set()).add(r["root"])
    large = {b for b, found in held.items() if 0 in found}
    assert all(held[b] == {0} for b in large) and len(large) > 1
    pairs = {(r["one"], r["two"]) for r in scratch.tables["pairs"].collect()}
    assert not [p for p in pairs if set(p) <= large]
    assert pairs == {tuple(sorted((b, c))) for b in held for c in set(held) - large if b == c or b in large}
