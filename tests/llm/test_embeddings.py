import numpy as np
import pytest

from tickflow.llm import embeddings, queries

SF = "/root/testdata/sf0.01"


def _brute(rows, cosine=0.95):
    """n_links and component by comparing all pairs in double precision; rows of distinct ids."""
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    links, low = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for k, (i, a) in enumerate(good):
        for j, b in good[k + 1 :]:
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                links[i] += 1
                links[j] += 1
                x, y = sorted((root(i), root(j)))
                low[y] = x
    return {i: (links[i], root(i), root(i) == i) for i, _ in rows}


@pytest.mark.parametrize("block", [4096, 64])
def test_query_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    rows = [tuple(r) for r in table.collect()]
    out = queries.QUERIES["op1_embeddings"](spark, SF).collect()
    assert len(out) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out} == _brute(rows)


def test_edges_copies_and_chains(spark):
    chance = np.random.default_rng(3)
    base = chance.standard_normal(5)
    chain = [(100 + k, [float(np.cos(0.25 * k)), float(np.sin(0.25 * k))]) for k in range(20)]
    rows = [(1, None), (2, []), (3, [0.0] * 5), (4, [1.0, None, 0.0, 0.0, 0.0]), (5, [float("nan")] * 5), (6, [float("inf"), 1.0, 0.0, 0.0, 0.0])]
    rows += [(10 + k, list(map(float, base * (k + 1)))) for k in range(6)] + [(20 + k, list(map(float, base))) for k in range(6)] + chain
    rows += [(50, [1e-200, 1e-200, 0.0]), (51, [1e200, 1e200, 0.0]), (-7, list(map(float, -base)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = embeddings.near_vectors(frame).collect()
    expected = _brute([r for r in rows if r[0] not in (50, 51)])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}
    assert {i: got[i] for i in expected} == expected
    assert got[50] == (1, 50, True) and got[51] == (1, 50, False)
    twice = embeddings.near_vectors(frame.union(frame).union(spark.createDataFrame([(None, [1.0])], frame.schema))).collect()
    assert len(twice) == 2 * len(rows) + 1 and {r.vec_id: (r.n_links, r.component_id, r.kept) for r in twice if r.vec_id is not None} == got
    assert embeddings.near_vectors(frame.limit(0)).count() == 0


def test_far_intervals_are_skipped(spark):
    rows = [(i, [1.0, i / 3000, 0.0] if i < 3000 else [0.0, i / 3000, 1.0]) for i in range(0, 6000, 5)]
    boxes = [(2, k, [float(k)] * 8, [k + 0.1] * 8) for k in range(37)]
    frame = spark.createDataFrame(boxes, "dim int, block long, low array<double>, high array<double>")
    pairs = embeddings.block_pairs(frame, 0.3).collect()
    assert sorted((p.a, p.b) for p in pairs) == [(k, k) for k in range(37)]
    wide = embeddings.block_pairs(frame, 2.6).collect()
    assert sorted((p.a, p.b) for p in wide) == sorted((k, j) for k in range(37) for j in (k, k + 1) if j < 37)
    assert len(embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()) == len(rows)
