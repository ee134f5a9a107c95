import random

import pytest
from pyspark.sql import functions as F

from tickflow.operators import enrich as en
from tickflow.operators import prefix
from tickflow.operators.prefix import carry_forward

START, END = "6217575821008262227", "6217575821008457285"


def logs(spark, rows):
    """rows: (tick, msg_seq, pos, ok, mark) with mark in S, E or any other text."""
    data = [
        (1, tick, seq, pos, ok, 255 if mark else 0, '{"customMessage":"%s"}' % {"S": START, "E": END}.get(mark, mark))
        for tick, seq, pos, ok, mark in rows
    ]
    return spark.createDataFrame(data, "epoch bigint, tick bigint, msg_seq bigint, pos bigint, ok boolean, type bigint, body string")


def brute_force(rows):
    """The state machine of one pass in arrival order."""
    out, by_message = {}, {}
    for tick, seq, pos, ok, mark in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if ok:
            by_message[(tick, seq)] = pos
    index, section, current = 0, False, None
    for tick, seq, pos, ok, mark in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if tick != current:
            index, section, current = 0, False, tick
        if not ok:
            continue
        dividend = False
        if mark == "S":
            section = True
        elif mark == "E":
            section = False
        else:
            dividend = section
        out[(tick, seq, pos)] = (index, by_message[(tick, seq)] == pos, dividend)
        index += 1
    return out


def enriched(frame, resume=None):
    rows = en.enrich(en.ok_logs(frame), resume).collect()
    return {(r["tick"], r["msg_seq"], r["pos"]): (r["index_in_tick"], r["last_log_for_tick"], r["dividend"]) for r in rows}


def test_dividend_examples(spark):
    rows = [(1, 1, i, True, m) for i, m in enumerate(["", "S", "", "", "E", ""])]
    assert [v[2] for _, v in sorted(enriched(logs(spark, rows)).items())] == [False, False, True, True, False, False]
    two = [(1, 1, i, True, m) for i, m in enumerate(["S", "", "E", "", "S", "x", "E"])]
    assert [v[2] for _, v in sorted(enriched(logs(spark, two)).items())] == [False, True, False, False, False, True, False]
    left_open = [(1, 1, 0, True, "S"), (1, 1, 1, True, ""), (2, 2, 0, True, "")]
    assert [v[2] for _, v in sorted(enriched(logs(spark, left_open)).items())] == [False, True, False]


def test_last_log_is_the_last_good_one_of_a_message(spark):
    rows = [(1, 1, 0, True, ""), (1, 1, 1, True, ""), (1, 1, 2, False, ""), (1, 2, 0, True, ""), (2, 3, 0, False, "")]
    assert {k: v[:2] for k, v in enriched(logs(spark, rows)).items()} == {
        (1, 1, 0): (0, False), (1, 1, 1): (1, True), (1, 2, 0): (2, True),
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_one_pass_with_a_hot_tick(spark, seed, monkeypatch):
    """A third of all rows in one tick, spread over many chunks and blocks."""
    monkeypatch.setattr(prefix, "BLOCK_BITS", 2)
    rng = random.Random(seed)
    rows = []
    for tick in range(20):
        messages = 900 if tick == 7 else rng.randint(1, 90)
        for seq in sorted(rng.sample(range(tick * 5000, tick * 5000 + 4000), messages)):
            for pos in range(rng.randint(1, 3)):
                mark = rng.choice(["", "", "", "", "S", "E", "x"]) if rng.random() < 0.2 else ""
                rows.append((tick, seq, pos, rng.random() > 0.1, mark))
    rng.shuffle(rows)
    assert enriched(logs(spark, rows)) == brute_force(rows)


def test_resume_continues_the_cut_tick(spark):
    rows = [(5, 1, 0, True, ""), (5, 1, 1, True, "E"), (5, 1, 2, True, ""), (6, 2, 0, True, "")]
    got = enriched(logs(spark, rows), {"tick": 5, "next_index": 4, "section_open": True})
    assert got == {
        (5, 1, 0): (4, False, True), (5, 1, 1): (5, False, False), (5, 1, 2): (6, True, False), (6, 2, 0): (0, True, False),
    }


def test_resumed_index_goes_on_at_the_stored_count(spark):
    stored = spark.createDataFrame([(1, 5), (1, 5)], "epoch bigint, tick bigint")
    again = logs(spark, [(5, 1, 0, True, ""), (5, 1, 1, True, ""), (5, 1, 2, True, ""), (6, 2, 0, True, "")])
    got = en.resumed_index(again, stored).orderBy("tick", "pos").collect()
    assert [r["index_in_tick"] for r in got] == [2, 3, 4, 0]


def test_chunks_are_computed_once(spark, tmp_path):
    rows = [(t, 1000 * t + m, 0, True, "S" if m == 0 else "") for t in range(5) for m in range(200)]
    logs(spark, rows).write.parquet(str(tmp_path / "logs"))
    frame = en.enrich(spark.read.parquet(str(tmp_path / "logs")))
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    # One scan for the rows and one, narrower, for the chunks; both levels read the same chunks.
    assert final.count("FileScan parquet") == 2
    assert "ReusedExchange" in final


@pytest.mark.parametrize("keys", [["k"], []])
def test_carry_forward(spark, keys, monkeypatch):
    monkeypatch.setattr(prefix, "BLOCK_BITS", 3)
    rng = random.Random(4)
    data = [
        (k, c, rng.randint(0, 9), rng.choice([None, None, 0, 1]))
        for k in range(3)
        for c in sorted(rng.sample(range(k * 1000, k * 1000 + 200), 60))
    ]
    frame = spark.createDataFrame(data, "k int, c bigint, n bigint, m int")
    got = {r["c"]: (r["before_n"], r["before_m"]) for r in carry_forward(frame, keys, "c", ["n"], ["m"]).collect()}
    expected, total, last, current = {}, 0, None, None
    for k, c, n, m in data:
        if keys and k != current:
            total, last, current = 0, None, k
        expected[c] = (total, last)
        total += n
        last = m if m is not None else last
    assert got == expected


def test_epoch_transitions(spark):
    messages = [(1, 10, 1), (2, 11, 1), (70000, 12, 2), (70001, 12, 1), (200000, 13, 2)]
    frame = spark.createDataFrame([(s, t, e, 0) for s, t, e in messages], "msg_seq bigint, tick bigint, epoch bigint, pos bigint")
    got = sorted(tuple(r) for r in en.epoch_transitions(frame).collect())
    assert got == [(70000, 12, 1, 2), (70001, 12, 2, 1), (200000, 13, 1, 2)]


def test_tick_batches(spark):
    rows = en.index_in_tick(logs(spark, [(1, 1, 0, True, ""), (1, 2, 0, True, ""), (2, 3, 0, True, "")]))
    rows = rows.withColumn("log_id", F.col("msg_seq") * 10)
    got = sorted(tuple(r) for r in en.tick_batches(rows).collect())
    assert got == [(1, 1, 2, 0, 1, 10, 20), (1, 2, 1, 0, 0, 30, 30)]
