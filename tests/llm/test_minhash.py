import random
import re

import numpy as np
import pytest

from tickflow.llm import minhash, queries
from tickflow.llm.components import components
from tickflow.llm.minhash import least_matches, near_duplicates

SF = "/root/testdata/sf0.001"


def sets_of(texts, size):
    out = {}
    for doc_id, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        size_here = min(size, len(words))
        out[doc_id] = {tuple(words[i : i + size_here]) for i in range(len(words) - size_here + 1)} if words else set()
    return out


def classes(sets, percent):
    low = {d: d for d in sets}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                low[y] = x
    return {d: root(d) for d in ids}


def test_query_against_brute_force(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    sets = sets_of(texts, 3)
    expected = classes(sets, 85)
    rows = queries.QUERIES["op3_minhash"](spark, SF).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {
        d: (len(sets[d]), expected[d], expected[d] == d) for d in sets
    }


def test_group_of_near_copies_in_one_bucket(spark):
    """Near copies of a few bases that share most words: links chain, and pairs straddle the threshold."""
    chance = random.Random(3)
    base = [chance.choice("abcdefgh") + str(chance.randrange(50)) for _ in range(120)]
    texts = []
    for i in range(90):
        words = list(base)
        for place in chance.sample(range(120), chance.choice((0, 1, 2, 3, 5))):
            words[place] = f"x{chance.randrange(1000)}"
        texts.append((i, " ".join(words)))
    expected = classes(sets_of(texts, 5), 80)
    out = near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), bands=25).collect()
    assert {r.doc_id: r.component_id for r in out} == expected


def test_copies_are_joined_around_their_source(spark):
    """Copies that are like their source, but not like each other; the source is not the smallest id."""
    chance = random.Random(9)
    base = [f"w{i}" for i in range(100)]
    texts = [(50, " ".join(base))]
    for i in range(50):
        words = list(base)
        for place in chance.sample(range(4, 96), 2):
            words[place] = f"x{i}y{place}"
        texts.append((i, " ".join(words)))
    expected = classes(sets_of(texts, 3), 85)
    out = near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), shingle=3, percent=85).collect()
    assert {r.doc_id: r.component_id for r in out} == expected and len(set(expected.values())) == 1


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (5, "One  TWO"), (None, "one two"), (6, "two one"), (7, "w " * 50_000), (8, "W " * 40_000)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string")
    out = near_duplicates(docs).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out}
    assert got[1] == (0, 1, True) and got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert got[4] == (1, 4, True) and got[5] == (1, 4, False) and got[6] == (1, 6, True)
    assert got[7] == (1, 7, True) and got[8] == (1, 7, False)
    assert got[None] == (1, None, True)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_bounds_keep_what_reaches_the_threshold():
    least = least_matches(0.8, 1e-6)
    chance = np.random.default_rng(1)
    agree = chance.random((20_000, 128)) < 0.8
    for step, bound in enumerate(least):
        assert (agree[:, : 16 * step].sum(axis=1) < bound).mean() < 1e-3
    assert (np.diff(least) >= 0).all() and least[-1] > 64


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(200)], [(5, 1), (1, 5), (9, 7), (7, 8), (100, 5)]])
def test_components(spark, edges):
    expected = classes({n: {n} for e in edges for n in e}, 101)
    low = dict(expected)
    for _ in range(len(edges)):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    frame = spark.createDataFrame(edges, "a long, b long").repartition(5)
    assert {r.node: r.component for r in components(frame).collect()} == {n: c for n, c in low.items() if n != c}


def test_copies_meet_in_the_text_they_are_like(spark, monkeypatch):
    """Copies that are only like the text they were made from, whose id is the largest: few tile rows are left after the rounds
    around a bucket's consensus, and the groups are those of all pairs."""
    monkeypatch.setattr(minhash, "_ROWS", 3)
    dice = random.Random(5)
    rows = []
    for group in range(3):
        base = [f"w{group}x{i}" for i in range(120)]
        for k in range(25):
            words = list(base)
            for at in dice.sample(range(120), 1):
                words[at] = f"edit{group}y{k}z{at}"
            rows.append((100 * group + k, " ".join(words)))
        rows.append((100 * group + 99, " ".join(base)))
    dice.shuffle(rows)
    expected = classes(sets_of(rows, 3), 93)
    assert len(set(expected.values())) == 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, shingle=3, percent=93).collect()}
    assert got == expected


def test_group_whose_members_nearly_reach_the_threshold(spark, monkeypatch):
    """Pairs that signatures cannot rule out are verified where they meet: no step hands on more rows than the buckets have members."""
    rows_of = {}

    def counted(frame, name):
        out = written(frame, name)
        rows_of[name] = max(rows_of.get(name, 0), out.count())
        return out

    written = minhash.written
    monkeypatch.setattr(minhash, "written", counted)
    chance = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(240):
        words = list(base)
        for place in chance.sample(range(0, 200, 4), 4):
            words[place] = f"x{i}y{place}"
        texts.append((i, " ".join(words)))
    expected = classes(sets_of(texts, 3), 85)
    assert 50 < len(set(expected.values())) < 240
    out = near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), shingle=3, percent=85).collect()
    assert {r.doc_id: r.component_id for r in out} == expected
    assert max(rows_of.values()) <= rows_of["buckets"]
