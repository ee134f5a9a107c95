import random
from collections import defaultdict

import numpy as np
import pytest

from tickflow.llm import line_dedup
from tickflow.llm.line_dedup import _grow_large, dedup_lines, grow, lines_of

LONG = "this notice stands word by word in very many documents of this corpus"


def _run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_dropped string, leaf string")
    return {r["doc_id"]: (r["text"], r["n_dropped"]) for r in dedup_lines(docs, "gone", **options).withColumnRenamed("n_dropped", "x").withColumnRenamed("gone", "n_dropped").collect()}


def test_repeats_across_documents(spark):
    rows = [
        (1, f"own first line of the text here\n{LONG}\nend", "a", "b"),
        (2, f"{LONG}\n{LONG}", "a", "b"),
        (3, None, "a", None),
        (4, "", None, "b"),
        (5, "page 3 of 17 was printed on 2021-04-05 at noon by me", "a", "b"),
        (6, "page 4 of 20 was printed on 2022-01-01 at noon by me\nunique words that stand in no other text at all", "a", "b"),
        (7, "short line here", "a", "b"),
        (8, "short line here", "a", "b"),
    ]
    out = _run(spark, rows)
    assert out[1] == (rows[0][1], 0)  # the first place stays
    assert out[2] == ("", 2)
    assert out[3] == (None, 0) and out[4] == ("", 0)
    assert out[5] == (rows[4][1], 0)
    assert out[6] == ("unique words that stand in no other text at all", 1)
    assert out[7] == out[8] == ("short line here", 0)


def test_likeness_empty_and_ids(spark):
    base = "the server of site alpha was started by user {} with all of its default options"
    rows = [(i, base.format(f"name{chr(97 + i)}"), None, None) for i in range(8)] + [(None, base.format("x"), None, None)]
    out = _run(spark, rows)
    assert [out[i][0] for i in range(8)] == [rows[0][1]] + [""] * 7
    assert out[None][0] == rows[-1][1]
    assert _run(spark, []) == {}
    # slices of a large leaf meet again
    assert _run(spark, rows, leaf_lines=2) == out


@pytest.mark.parametrize("size", ["sf0.001"])
def test_exact_repeats_against_brute_force(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    where = defaultdict(list)
    for doc_id in sorted(texts):
        for number, _, line, tokens in lines_of(texts[doc_id] or "", 4, 3):
            where[line, len(tokens)].append((doc_id, number))
    gone = defaultdict(set)
    for (_, n), places in where.items():
        if len({d for d, _ in places}) >= (2 if n >= 8 else 10):
            for doc_id, number in places[1:]:
                gone[doc_id].add(number)
    out = {r["doc_id"]: r["text"] for r in dedup_lines(docs, likeness=1.0).collect()}
    for doc_id, text in texts.items():
        assert out[doc_id] == "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[doc_id])


def test_lines_of_one_or_two_words(spark):
    rows = [(i, f"Menu\nShare this\n\nown{'abcdefghij'[i]} text", None, None) for i in range(10)]
    out = _run(spark, rows)
    assert out[0] == (rows[0][1], 0)
    assert [out[i] for i in range(1, 10)] == [(f"\nown{'abcdefghij'[i]} text", 2) for i in range(1, 10)]
    assert _run(spark, rows[:9]) == {i: (rows[i][1], 0) for i in range(9)}


def test_rows_of_numbers_are_told_apart(spark):
    table = lambda i: "\n".join(" ".join(str(1000 * i + 10 * j + k) for k in range(9)) for j in range(3))
    rows = [(i, table(i), None, None) for i in range(3)] + [(3, table(0), None, None)]
    out = _run(spark, rows)
    assert [out[i] for i in range(3)] == [(rows[i][1], 0) for i in range(3)]
    assert out[3] == ("", 3)  # equal rows go


def test_likeness_is_of_whole_token_hashes(spark):
    # 10 tokens of which 3 differ are never alike, whatever their hashes' last bytes
    rows = [(i, f"we are all of one mind here x{'abcdefghij'[i % 10]}q{chr(97 + i // 10)} y{chr(97 + i // 10)}v z{chr(97 + i % 26)}w{chr(97 + i // 26)}", None, None) for i in range(400)]
    texts = {r[0]: r[1].split() for r in rows}
    out = _run(spark, rows)
    for i, (text, n) in out.items():
        alike = any(sum(a != b for a, b in zip(texts[i], texts[j])) <= 2 for j in texts if j != i)
        assert alike or n == 0


@pytest.mark.parametrize("leaf_lines", [10, 25])
def test_groups_do_not_depend_on_the_size_of_a_leaf(spark, leaf_lines):
    dice = random.Random(7)
    lines = {}
    for n in (8, 12):
        for _ in range(3):
            base = ["a", "b", "c", "d"] + [dice.choice("xyz") for _ in range(n - 4)]
            for _ in range(12):
                line = list(base)
                for at in dice.sample(range(4, n), dice.randrange(0, n // 5 + 2)):
                    line[at] = dice.choice("pqrs")
                lines[tuple(line)] = n
    lines = sorted(lines)
    dice.shuffle(lines)
    rows, expected = [], {}
    for n in (8, 12):
        of = [(i, x) for i, x in enumerate(lines) if len(x) == n]
        codes = np.array([[ord(t) for t in x] for _, x in of], np.uint64)
        heads = []
        for i, x in of:  # brute force: the first head that differs in a fifth of the places at most
            near = [h for h in heads if sum(a != b for a, b in zip(x, lines[h])) <= n // 5]
            expected[i] = near[0] if near else i
            heads += [] if near else [i]
        assert [of[j][0] for j in grow(codes, n // 5)] == [expected[i] for i, _ in of]
        rows += [(n, i, bytearray(row.tobytes())) for (i, _), row in zip(of, codes)]
    frame = spark.createDataFrame(rows, "leaf long, line long, tokens binary")
    found = {r.line: r.head for r in _grow_large(frame, 0.8, leaf_lines).collect()}
    assert {i: found.get(i, i) for i in expected} == expected


@pytest.mark.parametrize("n", [40, 100])
def test_cells_of_a_large_leaf_stay_few(spark, monkeypatch, n):
    """5,000 lines of one leaf, two in five places variable, among them alike ones: few cell rows a line, the heads of one pass."""
    dice = np.random.default_rng(n)
    variable = np.sort(dice.choice(np.arange(4, n), 2 * n // 5, replace=False))
    codes = np.tile(np.arange(n, dtype=np.uint64), (5000, 1))
    codes[:, variable] = dice.integers(1000, 1060, (5000, len(variable)))
    for i in range(0, 5000, 50):  # every 50th line is one before it, changed in a few places
        codes[i + 1] = codes[i]
        codes[i + 1, dice.choice(variable, n // 10, replace=False)] = 7
    counted = []
    kept = line_dedup.written

    def counting(df, name):
        out = kept(df, name)
        if name == "cells":
            counted.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "written", counting)
    frame = spark.createDataFrame([(1, i, bytearray(row.tobytes())) for i, row in enumerate(codes)], "leaf long, line long, tokens binary")
    found = {r.line: r.head for r in _grow_large(frame, 0.8, 500).collect()}
    assert found == {i: h for i, h in enumerate(grow(codes, n // 5).tolist()) if i != h} and len(found) >= 100
    # Pieces: one more than alike lines may differ in.
    assert sum(counted[1:]) <= 5000 * (n // 5 + 1) and len(counted) == 2


def test_large_leaves_drop_the_same_lines(spark):
    texts = ["a b c d e f g X", "a b c d e f g h", "a b c d e f Y X", "a b c d e f Y h", "a b c d Z f Y X", "a b c d Z f Y W"]
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    assert _run(spark, rows, leaf_lines=1) == _run(spark, rows, leaf_lines=2) == _run(spark, rows)
