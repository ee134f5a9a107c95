import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow.llm.fill_middle import BOUND, fill_in_middle, rank_index, restored


def by_hand(doc_id, text, transformed=90, suffix_first=20):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= transformed:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return (doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


ODD = ["", "a", "é", "𝔘", "<P>x", "a<S>", "<M>", "<", "<P", "<S<", ">P>S>M", "中<" * 50, "\0\n<é>" * 40, "é" * 30]


@pytest.mark.parametrize("letters", ["ab", "aé", "é", "aé中𝔘", "𝔘", "a" * 400 + "𝔘"])
def test_every_boundary_is_found(letters):
    chance = random.Random(letters)
    for n in (1, 2, 127, 128, 5000, 20_000):
        text = "".join(chance.choices(letters, k=n))
        text = "".join(sorted(text)) if n == 20_000 else text  # long stretches of one width
        index = rank_index(text.encode())
        ends = np.cumsum([0] + [len(c.encode()) for c in text])
        step = max(1, n // 300)
        assert [index.byte(k) for k in range(0, n + 1, step)] == ends[::step].tolist()
        assert index.byte(n) == ends[-1]
        assert max(abs(r.astype(int)).max() for r in index.residuals) <= BOUND + 1


def test_a_text_longer_than_a_stretch():
    text = "aé中𝔘" * 250_000
    index = rank_index(text.encode())
    for rank in (0, 1, 7, 419_430, 419_431, 500_001, 999_999, 1_000_000):
        assert index.byte(rank) == len(text[:rank].encode())
    assert len(index.first) < 100


def test_rows_against_slices(spark):
    chance = random.Random(3)
    rows = [(i, "".join(chance.choices("ab é中𝔘<>PSM", k=chance.randrange(60)))) for i in range(400)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD * 6)] + [(5, None), (None, "no id é"), (7, "twice"), (7, "twice")]
    # Columns that clash with those of the result are not looked at.
    docs = spark.createDataFrame([(*r, "x", "y", None) for r in rows], "doc_id long, text string, form string, output string, n int")
    cut = fill_in_middle(docs)
    out = cut.withColumn("again", restored("output", "form")).collect()
    assert sorted((tuple(r)[:6] for r in out), key=str) == sorted((by_hand(*r) for r in rows), key=str)
    assert sorted(((r.doc_id, r.again) for r in out), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert {"plain", "psm", "spm"} == {r.form for r in out}
    assert fill_in_middle(docs.limit(0)).count() == 0


def test_shares_are_parameters(spark):
    docs = spark.createDataFrame([(i, "some text") for i in range(300)], "doc_id long, text string")
    assert {r.form for r in fill_in_middle(docs, transformed=0).collect()} == {"plain"}
    assert {r.form for r in fill_in_middle(docs, transformed=100, suffix_first=100).collect()} == {"spm"}
    forms = [r.form for r in fill_in_middle(docs, seed=9).collect()]
    assert 0.8 < 1 - forms.count("plain") / 300 < 0.97
    assert fill_in_middle(docs).filter(F.col("output").contains("<M>")).count() == sum(by_hand(i, "some text")[2] != "plain" for i in range(300))
