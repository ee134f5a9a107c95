from hashlib import sha256

import numpy as np
import pytest

from tickflow.llm import fingerprints as fp
from tickflow.llm import queries

SF = "/root/testdata/sf0.001"


def _expected(rows, tie=lambda text: text):
    """Brute force: sort, edit, and fingerprint one text at a time."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(t) // 4
        changed = t[: len(t) - n] + after[:n]
        a, b, c = (fp.fingerprints([x])[0] for x in (t, changed, after))
        out.append((i, len(t), sha256(changed.encode()).hexdigest(), fp.as_text(a), fp.as_text(b), fp.likeness(a, b), fp.likeness(a, c)))
    return out


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.QUERIES["op5_fingerprints"](spark, SF).collect()))
    assert got == sorted(_expected(rows))
    assert np.mean([r[5] for r in got if r[1] > 200]) > 0.5
    assert np.mean([r[6] < 0.3 for r in got if r[1] > 200]) > 0.8


def test_edges(spark):
    rows = [(3, None), (1, ""), (2, "a" * 5000), (2, "a" * 5000), (9, "abc"), (None, "some text of no id"), (7, "x" + "abcdefgh" * 9000), (8, "é𝔘" * 3)]
    docs = spark.createDataFrame([(i, t, "b") for i, t in rows], "doc_id long, text string, block string")
    for size in (1, 3, 1024):
        got = fp.with_next(docs, size).mapInArrow(fp._blocks, fp._SCHEMA).collect()
        assert sorted(map(tuple, got), key=str) == sorted(_expected(rows), key=str)
    assert fp.fingerprint_documents(docs.limit(0)).count() == 0
    assert fp.fingerprint_documents(docs.limit(1)).count() == 1


def test_rows_that_share_an_id_are_dealt_to_many_blocks(spark):
    """300 texts of one id and 100 without an id lie in several blocks, in the order of their hashes."""
    rows = [(4, f"text number {i} " * 9) for i in range(300)] + [(None, f"no id {i} " * 9) for i in range(100)] + [(5, "last one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = {r.text: r.mark for r in docs.selectExpr("text", "xxhash64(text) as mark").collect()}
    dealt = fp.with_next(docs, rows=40)
    assert dealt.filter("not beyond").groupBy("block").count().count() >= 8
    got = sorted(map(tuple, dealt.mapInArrow(fp._blocks, fp._SCHEMA).collect()), key=str)
    assert got == sorted(_expected(rows, marks.__getitem__), key=str)


@pytest.mark.parametrize("shift", [1, 7, 50])
def test_equal_substrings_share_names_at_any_offset(shift):
    chance = np.random.default_rng(4)
    text = "".join(chance.choice(list("abcdefghij "), 6000))
    a, b = fp.fingerprints([text, "".join(chance.choice(list("klmn"), shift)) + text])
    assert fp.likeness(a, b) > 0.9
    together = fp.fingerprints([text, "q", text])
    assert (together[0] == a).all() and (together[2] == a).all()
