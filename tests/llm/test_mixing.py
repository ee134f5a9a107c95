import re
from collections import defaultdict

import pytest

from tickflow.llm import mixing, queries

SF = "/root/testdata/sf0.01"


def water(sizes, weights=(5, 2, 1), cap=3):
    """Targets by filling, source by source; null is the last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if cap * sizes[s] <= unit * weight[s]}
        for s in full or open_:
            target[s] = float(cap * sizes[s]) if full else unit * weight[s]
        if not full:
            break
        open_ -= full
        left -= sum(target[s] for s in full)
    return target


def test_query_meets_targets(spark):
    rows = queries.QUERIES["op2_mixing"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or ""))
        assert r.taken % max(1, r["size"]) == 0 and r.taken <= 3 * r["size"]
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    goal = water(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source], rel=1e-9)
    for source in sizes:
        assert abs(taken[source] - goal[source]) <= max(20, 0.003 * goal[source])
    again = queries.QUERIES["op2_mixing"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_expected_copies_are_kept(spark):
    """Over seeds, a document's mean copies come near what it is due, large or small."""
    rows = [("s", i, 10 + 37 * i % 400, 0, 0.3) for i in range(40)]
    frame = spark.createDataFrame(rows, "source string, id long, size long, whole int, p double")
    taken = defaultdict(list)
    for seed in range(12):
        for r in mixing.pivotal(frame, seed, bucket=16).collect():
            taken[r.id].append(r.copies)
    assert all(len(c) == 12 and set(c) <= {0, 1} for c in taken.values())
    mean = sum(sum(c) for c in taken.values()) / (12 * 40)
    assert 0.2 < mean < 0.4


def test_edges(spark):
    rows = [
        (1, "a b c d e f", None), (2, None, "s"), (3, "", "s"), (4, " \n\t", "t"), (5, "w " * 5000, "s"),
        (6, "one two", "s"), (6, "one two", "s"), (None, "x y z", "t"), (7, "q r s t", "é"), (8, "q r s t", "z"),
    ]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, source string, size string")
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    assert all(r.copies == 0 for r in out if r["size"] == 0)
    sizes = defaultdict(int)
    for r in out:
        sizes[r.source] += r["size"]
    goal = water(sizes)
    assert {r.source: r.target for r in out} == pytest.approx(goal)
    copies = sum(r.copies for r in out)
    kept = mixing.repeated(docs)
    assert kept.columns == docs.columns and kept.count() == copies
    assert mixing.mix(docs.limit(0)).count() == 0
    assert {r.target for r in mixing.mix(docs.filter("doc_id in (2, 3)")).collect()} == {0.0}


def test_rows_that_repeat_are_taken_singly(spark, monkeypatch):
    """A source of one document sent 200 times, and one of two: targets are met to a row, and the rows taken are whole rows."""
    monkeypatch.setattr(mixing, "_ROWS_AT_ONCE", 16)
    rows = [(1, "five words stand right here", "a")] * 200 + [(2, "other five words stand here", "b")] * 100 + [(3, "x y z", "b"), (None, "n n", "b"), (None, "n n", "b")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, source string, row long").repartition(6)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in out:
        sizes[r.source] += r["size"]
        taken[r.source] += r["size"] * r.copies
    goal = water(sizes)
    for source in sizes:
        assert abs(taken[source] - goal[source]) <= 5
    kept = mixing.repeated(docs).collect()
    copies = defaultdict(int)
    for r in kept:
        copies[r.row] += 1
        assert tuple(r)[:3] == rows[r.row]
    assert sorted(copies.values()) == sorted(r.copies for r in out if r.copies)
    again = mixing.repeated(docs).collect()
    assert len(again) == len(kept)


def test_no_python_on_the_way(spark):
    plan = queries.QUERIES["op2_mixing"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
