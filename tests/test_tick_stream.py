import json
import random

import pytest
from pyspark.sql import functions as F

from tickflow.functions.json_text import _plain
from tickflow.operators.enrich import enrich, ok_logs, tick_runs
from tickflow.sinks.tables import read_events
from tickflow.sources.tick_stream import arrival_numbers, explode_logs, parse_messages, read_tick_stream, with_place
from tickflow.streaming.bridge import BridgeTables, process_bridge_batch

from .test_jobs import METHOD, lines, log, message, put


def exploded(spark, *texts):
    return explode_logs(parse_messages(lines(spark, *texts), METHOD))


# ------------------------------------------------------------------ logs one by one


@pytest.mark.parametrize(
    ("field", "value", "reason"),
    [
        ("epoch", 70000, "epoch"), ("epoch", -1, "epoch"), ("epoch", "7", "epoch"), ("epoch", 1.5, "epoch"),
        ("tick", 2**40, "tick"), ("type", 2**32, "type"), ("bodySize", -5, "bodySize"), ("logId", 2**64, "logId"), ("logId", -1, "logId"),
        ("logDigest", 5, "logDigest"), ("txHash", [], "txHash"), ("ok", "yes", "ok"), ("body", [1], "body"), ("body", "text", "body"),
        ("timestamp", 2**63, "timestamp"), ("logTypename", {}, "logTypename"),
        ("epoch", 65535, None), ("tick", 2**32 - 1, None), ("logId", 2**64 - 1, None), ("txHash", None, None), ("body", None, None), ("ok", False, None),
    ],
)
def test_fields_of_a_log(spark, field, value, reason):
    rows = exploded(spark, message(log(1), {**log(2), field: value}, log(3))).orderBy("pos").collect()
    assert [r["log_error"] for r in rows] == [None, reason, None]
    assert [int(r["log_id"]) for r in rows][::2] == [1, 3]
    if reason:
        bad = rows[1]
        assert bad["ok"] and json.loads(bad["rejected_text"])[field] == value
        assert bad["epoch"] == 1 and bad["tick"] == 10  # its own, or else its message's


def test_logs_that_are_no_objects(spark):
    text = message(log(1)).replace("[{", '[null, 7, "x", {', 1)
    rows = exploded(spark, text).orderBy("pos").collect()
    assert [(r["ok"], r["log_error"]) for r in rows] == [(False, None), (True, "json"), (True, "json"), (True, None)]
    assert (rows[1]["epoch"], rows[1]["tick"], rows[1]["rejected_text"]) == (1, 10, "7")


@pytest.mark.parametrize("result", [{"epoch": 70000}, {"tick": 2**32}, {"tick": -1}, {"logs": 5}, {"epoch": "1"}])
def test_envelopes_out_of_range_are_malformed(spark, result):
    parsed = parse_messages(lines(spark, message(log(1), **result), message(log(2))), METHOD)
    assert [(r["kind"], r["malformed_text"] is None) for r in parsed.collect()] == [("malformed", False), ("ticks", True)]


def test_a_rejected_log_keeps_its_place(spark, tmp_path):
    """Ticks 7 and 8 lose their first and their last log; both can still be completed."""
    tables = BridgeTables(str(tmp_path / "out"))
    batch = lines(
        spark,
        message(log(1, tick=7, epoch=70000), log(2, tick=7), log(3, tick=7), tick=7),
        message(log(4, tick=8), log(5, tick=8), log(6, tick=8, body={"from": 5}), tick=8),
        "{broken",
    )
    process_bridge_batch(batch, 0, tables, METHOD, mode="quarantine")
    topic = sorted((json.loads(r["value"]) for r in spark.read.text(tables.topic).collect()), key=lambda v: (v["tickNumber"], v["index"]))
    assert [(v["tickNumber"], v["index"], v["type"], v.get("lastLogForTick", False), v.get("rejected")) for v in topic] == [
        (7, 0, 32767, False, "epoch"), (7, 1, 0, False, None), (7, 2, 0, True, None),
        (8, 0, 0, False, None), (8, 1, 0, False, None), (8, 2, 32767, True, "from"),
    ]
    assert sorted(int(r["log_id"]) for r in read_events(spark, tables.events).collect()) == [2, 3, 4, 5]
    errors = spark.read.parquet(tables.errors)
    assert errors.count() + 4 == 6 + 1  # errors and published logs are the logs that came, and the broken message
    process_bridge_batch(lines(spark, message(log(7, tick=9), tick=9)), 0, tables, METHOD, mode="quarantine")
    assert spark.read.parquet(tables.errors).count() == 0  # a batch that runs again replaces its errors, also by none


# ------------------------------------------------------------------ arrival


def test_a_message_sent_twice(spark, tmp_path):
    """In one batch, and in two: indices go on, and each copy has a last log of its own."""
    text = message(log(1), log(2))
    for name, batches in (("one", [[text, text]]), ("two", [[text], [text]])):
        tables = BridgeTables(str(tmp_path / name))
        for batch, texts in enumerate(batches):
            process_bridge_batch(lines(spark, *texts).coalesce(1), batch, tables, METHOD)
        values = sorted((json.loads(r["value"]) for r in spark.read.text(tables.topic).collect()), key=lambda v: v["index"])
        assert [(v["logId"], v["index"], v.get("lastLogForTick", False)) for v in values] == [(1, 0, False), (2, 1, True), (1, 2, False), (2, 3, True)]
        rows = read_events(spark, tables.events).orderBy("log_id").collect()
        assert [(int(r["log_id"]), r["index_in_tick"]) for r in rows] == [(1, 2), (2, 3)]


def test_file_places_are_arrival_numbers(spark, tmp_path):
    folder = str(tmp_path / "in")
    texts = [message(log(i), tick=i // 7) for i in range(60)]
    for name, part in (("a.txt", texts[:25]), ("b.txt", texts[25:26]), ("c.txt", texts[26:])):
        put(folder, name, *part)
    parsed = parse_messages(with_place(read_tick_stream(spark, folder)), METHOD)
    got = arrival_numbers(parsed).select("msg_seq", F.get_json_object(F.col("result.logs")[0], "$.logId").cast("int").alias("id")).orderBy("msg_seq").collect()
    assert [r["id"] for r in got] == list(range(60)) and len({r["msg_seq"] for r in got}) == 60


def test_offsets_of_several_partitions_do_not_collide(spark):
    rows = spark.createDataFrame([(p, o) for p in range(3) for o in range(5 + p, 15, 1 + p)], "partition int, offset bigint")
    got = arrival_numbers(rows.repartition(4)).collect()
    assert len({r["msg_seq"] for r in got}) == len(got)
    order = [(r["partition"], r["offset"]) for r in sorted(got, key=lambda r: r["msg_seq"])]
    assert order == sorted(order)
    own = spark.createDataFrame([(9,)], "msg_seq bigint")
    assert arrival_numbers(own).first()["msg_seq"] == 9


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_of_ticks_against_one_pass(spark, seed, monkeypatch):
    monkeypatch.setattr("tickflow.operators.enrich._NARROW_CHUNK_BITS", 3)
    chance = random.Random(seed)
    ticks, tick = [], 5
    for _ in range(300):
        tick = chance.choice([tick, tick, tick, tick + 1, max(1, tick - 1)])
        ticks.append(tick)
    seqs = sorted(chance.sample(range(5000), 300))
    rows = spark.createDataFrame([(s, (t,)) for s, t in zip(seqs, ticks)], "msg_seq bigint, result struct<tick: bigint>").repartition(5)
    expected, run = {}, 0
    for i, (s, t) in enumerate(zip(seqs, ticks)):
        run += i > 0 and ticks[i - 1] != t
        expected[s] = run
    assert {r["msg_seq"]: r["run"] for r in tick_runs(rows).collect()} == expected


def test_indices_by_run(spark):
    texts = [message(log(1, tick=3), log(2, tick=3), tick=3), message(log(3, tick=4), tick=4), message(log(1, tick=3), tick=3), message(log(9, tick=3), tick=3)]
    parsed = parse_messages(lines(spark, *texts).coalesce(1).withColumn("msg_seq", F.monotonically_increasing_id()), METHOD)
    rows = enrich(ok_logs(explode_logs(tick_runs(parsed)))).orderBy("msg_seq", "pos").collect()
    assert [(r["tick"], r["index_in_tick"]) for r in rows] == [(3, 0), (3, 1), (4, 0), (3, 0), (3, 1)]


def test_places_are_numbered_without_a_shuffle_of_messages(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([("b", 0, 7, "x"), ("a", 0, 3, "y"), ("a", 9, 5, "z"), ("a", 0, 4, "w")], "file string, block long, offset long, text string")
        numbered = arrival_numbers(rows)
        assert "SortMergeJoin" not in numbered._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["msg_seq"], r["text"]) for r in numbered.collect()) == [(0, "y"), (1, "w"), (2, "z"), (3, "x")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(
    "text, plain",
    [('{"a":"x"}', True), ('{"b":1}', True), ('{"a":1}', False), ('{"a":"x","a":"y"}', False), ('{"a":"x","b":{"a":1}}', False), ('{"a":"éé"}', True), ('{"a":"a"a"}', False)],
)
def test_a_key_that_stands_once_before_a_text_is_plain(spark, text, plain):
    test = _plain("t", "a", '"')
    assert "locate" not in test  # it counts characters anew from the start each time
    assert spark.createDataFrame([(text,)], "t string").selectExpr(f"{test} p").first()["p"] is plain
