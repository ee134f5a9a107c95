import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickflow.operators.bodies import parse_body
from tickflow.operators.enrich import enrich, ok_logs
from tickflow.operators.events import events_in_range
from tickflow.operators.messages import build_event_message, to_stored_event, to_topic_rows
from tickflow.operators.metrics import rpc_errors
from tickflow.operators.validate import BadRecords
from tickflow.plans import feeds, jobs
from tickflow.schemas import STORED_COLUMNS
from tickflow.sinks.files import write_bulk_ndjson, write_event_ndjson
from tickflow.sinks.tables import PROGRESS_SCHEMA, compact_events, read_documents, read_events
from tickflow.sources.tick_stream import explode_logs, parse_messages, read_rpc_logs, read_tick_stream
from tickflow.sources.topic import read_event_ndjson
from tickflow.streaming import bridge
from tickflow.streaming.bridge import BridgeTables, process_bridge_batch, run_bridge, start_position
from tickflow.streaming.index import IndexTables, read_highest_tick, run_index
from tickflow.streaming.replay import run_replay

from .conftest import SF


METHOD = "node_subscription"


def log(log_id, tick=10, **more):
    base = {"ok": True, "epoch": 1, "tick": tick, "type": 0, "logId": log_id, "logDigest": "d", "bodySize": 1,
            "timestamp": 1700000000, "txHash": "", "body": {"from": "a", "to": "b", "amount": 1}}
    base.update(more)
    return {k: v for k, v in base.items() if v is not ...}


def message(*logs, tick=10, method=METHOD, **result):
    return json.dumps(
        {"jsonrpc": "2.0", "method": method, "params": {"subscription": "s", "result": {"epoch": 1, "tick": tick, "logs": list(logs), **result}}}
    )


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def put(folder, name, *texts, at=None):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write("\n".join(texts) + "\n")
    if at is not None:  # file sources take older files first
        os.utime(path, (at, at))


def events_of(frame):
    columns = [c for c in STORED_COLUMNS]
    return sorted(tuple(str(r[c]) for c in columns) for r in frame.select(*columns).collect())


# ------------------------------------------------------------------ sources


def test_message_kinds(spark):
    texts = [
        message(log(1)),
        message(catchUpComplete=True),
        '{"jsonrpc":"2.0","id":1,"error":{"code":-32000,"message":"no"}}',
        '{"jsonrpc":"2.0","id":1,"result":"0xabc"}',
        '{"jsonrpc":"2.0","method":"other","params":{}}',
        "{broken",
    ]
    parsed = parse_messages(lines(spark, *texts), METHOD)
    assert [r["kind"] for r in parsed.select("kind").collect()] == [
        "ticks", "catch_up_complete", "error", "unknown", "unknown", "malformed",
    ]
    assert [tuple(r) for r in rpc_errors(parsed).collect()] == [("jsonrpc_-32000", 1)]
    strict = parse_messages(lines(spark, texts[0]), method="exact_name")
    assert strict.first()["kind"] == "unknown"


def test_explode_orders_messages_by_their_lowest_good_log(spark):
    parsed = parse_messages(lines(spark, message(log(5), log(6)), message(log(0, ok=False), log(3), log(4)), message()), METHOD)
    rows = explode_logs(parsed).orderBy("msg_seq", "pos").select("msg_seq", "pos", "log_id", "ok").collect()
    assert [(r[0], r[1], int(r[2]), r[3]) for r in rows] == [(3, 0, 0, False), (3, 1, 3, True), (3, 2, 4, True), (5, 0, 5, True), (5, 1, 6, True)]


def test_log_defaults_and_bodies(spark):
    parsed = parse_messages(lines(spark, message({"ok": True, "tick": 1, "epoch": 1, "logId": 2**64 - 1}, log(1, body=None))), METHOD)
    rows = parse_body(explode_logs(parsed)).orderBy("pos").collect()
    assert int(rows[0]["log_id"]) == 2**64 - 1 and rows[0]["timestamp"] == 0 and rows[0]["tx_hash"] == ""
    assert rows[0]["parsed"] is None and rows[0]["parse_error"] is None  # absent body
    assert rows[1]["parsed"]["from"] == "" and rows[1]["parsed"]["amount"] == 0  # JSON null body


def test_rpc_response_files(spark, tmp_path):
    put(str(tmp_path / "in"), "a.json", json.dumps({"result": [log(1), log(2, ok=False)]}, indent=1))
    rows = read_rpc_logs(spark, str(tmp_path / "in")).orderBy("pos").collect()
    assert [(r["pos"], int(r["log_id"]), r["ok"]) for r in rows] == [(0, 1, True), (1, 2, False)]


def test_ndjson_files(spark, tmp_path):
    rows = parse_messages(lines(spark, message(log(1), log(2))), METHOD)
    messages = build_event_message(parse_body(enrich(ok_logs(explode_logs(rows)))))
    write_event_ndjson(messages, str(tmp_path / "events"))
    put(str(tmp_path / "more"), "x.txt", "", '  {"a":1}  ', "   ")
    texts = [json.loads(r["value"]) for r in read_event_ndjson(spark, str(tmp_path / "events")).collect()]
    assert sorted(t["index"] for t in texts) == [0, 1]
    assert {tuple(sorted(t)) for t in texts} == {
        ("body", "bodySize", "epoch", "index", "logDigest", "logId", "tickNumber", "timestamp", "transactionHash", "type"),
        ("body", "bodySize", "epoch", "index", "lastLogForTick", "logDigest", "logId", "tickNumber", "timestamp", "transactionHash", "type"),
    }
    assert [r["value"] for r in read_event_ndjson(spark, str(tmp_path / "more")).collect()] == ['{"a":1}']


def test_message_without_body_says_null(spark):
    rows = parse_body(enrich(ok_logs(explode_logs(parse_messages(lines(spark, message(log(1, type=255, body=...))), METHOD)))))
    value = json.loads(to_topic_rows(build_event_message(rows)).first()["value"])
    assert value["body"] is None and "dividend" not in value and value["lastLogForTick"] is True


def test_bulk_file(spark, tmp_path):
    routed = feeds.routed_e(spark, SF).filter("status = 'processed'")
    write_bulk_ndjson(routed, str(tmp_path / "bulk"), "idx")
    texts = [r["value"] for r in spark.read.text(str(tmp_path / "bulk")).collect()]
    assert len(texts) == 2 * routed.count()
    for action, doc in zip(texts[::2], texts[1::2], strict=True):
        assert json.loads(action)["index"]["_id"] == "{epoch}-{logId}".format(**json.loads(doc))


# ------------------------------------------------------------------ bridge


@pytest.fixture(scope="module")
def feed_texts(spark):
    """The feed's messages in arrival order."""
    rows = feeds.feed_messages(spark, SF).withColumn("first", F.regexp_extract("value", '"logId":(\\d+)', 1).cast("bigint"))
    return [r["value"] for r in rows.orderBy("first").select("value").collect()]


@pytest.mark.parametrize("files", [1, 3, 7])
def test_bridge_stream_equals_batch(spark, tmp_path, feed_texts, files):
    step = -(-len(feed_texts) // files)
    for i in range(files):
        put(str(tmp_path / "in"), f"{i}.txt", *feed_texts[i * step : (i + 1) * step], at=1_700_000_000 + i)
    stream = read_tick_stream(spark, str(tmp_path / "in"), streaming=True, max_files=1)
    root = str(tmp_path / "out")
    run_bridge(stream, root, f"{root}/checkpoint", feeds.METHOD).awaitTermination()
    tables = BridgeTables(root)
    expected = feeds.enriched_e(spark, SF)
    assert events_of(read_events(spark, tables.events)) == events_of(to_stored_event(expected))
    topic = sorted(r["value"] for r in spark.read.text(tables.topic).select("value").collect())
    assert topic == sorted(r["value"] for r in feeds.topic_e(spark, SF).select("value").collect())
    last = expected.agg(F.max("tick")).first()[0]
    assert start_position(spark, tables, initial_tick=1).first()[0] == last + 1


def test_feed_arrives_in_even_files_a_batch_at_a_time(spark, tmp_path, monkeypatch):
    """Numbers with wide gaps: files of equal size all the same, whole batches one after another, every message once and in order."""
    monkeypatch.setattr(jobs, "_FILE_MESSAGES", 10)
    monkeypatch.setattr(jobs, "_BATCH_FILES", 2)
    messages = spark.range(100).selectExpr("id * id * id msg_seq", "0L tick", "explode(array(0, 1)) copy")
    messages = messages.selectExpr("*", "concat(msg_seq, ' ', copy) value").repartition(7)
    path, seen = str(tmp_path / "in"), []
    for _ in jobs.messages_in_order(messages, path, batches=4):
        seen.append(sorted(f for f in os.listdir(path) if f.endswith(".txt")))
    assert len(seen) == 10 and all(a == b[: len(a)] for a, b in zip(seen, seen[1:]))
    texts = [open(f"{path}/{f}").read().splitlines() for f in seen[-1]]
    assert len(texts) == 20 and all(6 <= len(t) <= 14 for t in texts)
    assert [tuple(map(int, line.split())) for t in texts for line in t] == [(i**3, copy) for i in range(100) for copy in (0, 1)]
    assert list(jobs.messages_in_order(messages.filter("false"), path)) == []


def test_batches_outweigh_what_each_of_them_costs(spark, tmp_path, monkeypatch):
    """A long feed arrives whole, in batches of many files, not in one for every few."""
    monkeypatch.setattr(jobs, "_FILE_MESSAGES", 10)
    messages = spark.range(400).selectExpr("id msg_seq", "0L tick", "0 copy", "cast(id as string) value").repartition(7)
    path, seen = str(tmp_path / "in"), []
    for _ in jobs.messages_in_order(messages, path, batches=4):
        seen.append(sorted(f for f in os.listdir(path) if f.endswith(".txt")))
    assert len(seen) == 4 and len(seen[-1]) == 40
    assert [int(line) for f in seen[-1] for line in open(f"{path}/{f}").read().splitlines()] == list(range(400))


def events(spark, path, n):
    """A table of events in one file of one row group."""
    types = "element_at(array('click', 'signup', 'purchase', 'error', 'view'), cast(id % 5 + 1 as int))"
    rows = spark.range(n).selectExpr(
        "id event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 300) ts", "id % 40 user_id",
        f"{types} event_type", "id * 1.5D value", "concat('{\"k\": ', id * 7 % 100, '}') props",
    )
    rows.coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_feed_texts_are_made_after_the_table_is_shuffled(spark, tmp_path):
    """A table of one row group is read by one task; logs and texts are not to be made there, and are not shuffled once more."""
    sf_dir = events(spark, tmp_path, 400)
    for feed in (feeds.feed_messages, feeds.broken_messages):
        plan = feed(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.index("Exchange") > plan.rindex("StructsToJson") and plan.index("Exchange") > plan.rindex("get_json_object")
    messages = sorted(map(tuple, feeds.feed_messages(spark, sf_dir).collect()), key=str)
    assert messages == sorted(map(tuple, feeds._as_messages(feeds.log_texts(spark, sf_dir)).collect()), key=str)
    assert len({(m[0], m[1]) for m in messages}) == len(messages) and sum(m[2].count('"logId"') for m in messages) == 400


def test_ticks_to_look_up_are_found_once(spark, tmp_path, monkeypatch):
    """The table of events is read once for the ticks that ``stream_lookup`` asks for, however often they are asked."""
    sf_dir = events(spark, tmp_path, 400)
    logs, asked = feeds.feed_e(spark, sf_dir).filter("ok"), []
    jobs.events_table(spark, str(tmp_path / "table")).append(to_stored_event(feeds.enriched_e(spark, sf_dir)), 0, "index_in_tick")
    monkeypatch.setattr(jobs, "_resent_part", lambda *_: BridgeTables(str(tmp_path)))
    monkeypatch.setattr(jobs, "events_table", lambda *_: bridge.events_table(spark, str(tmp_path / "table")))
    found, look = jobs.events.events_for_ticks, lambda rows, wanted: asked.append(wanted) or found(rows, wanted)
    monkeypatch.setattr(jobs.events, "events_for_ticks", look)
    rows = jobs.stream_lookup(spark, sf_dir)
    assert not any("events.parquet" in f for f in asked[0].inputFiles())
    ticks = [r["tick"] for r in logs.select("tick").distinct().collect()]
    assert {r["tick"] for r in rows.collect()} == {t for t in ticks if t % 50 == 0} | {min(ticks) - 1}


def test_progress_compares_the_last_run_only(spark):
    rows = [(run, i, 100 - run, 3, run * 10 + i, i == 1) for run in range(4) for i in range(3 if run < 3 else 2)]
    schema = "run bigint, index_in_tick bigint, tick bigint, epoch bigint, log_id bigint, dividend boolean"
    enriched = spark.createDataFrame(rows, schema).withColumn("log_id", F.col("log_id").cast("decimal(20,0)")).withColumn("parsed", F.struct(F.lit(None).cast("string").alias("customMessage")))
    none = spark.createDataFrame([], PROGRESS_SCHEMA)
    new = bridge.progress_row(enriched, none)
    assert "hashpartitioning(run" not in new._jdf.queryExecution().executedPlan().toString()
    saved = [(3, 31, 97, 2, True)]
    assert [tuple(r) for r in new.collect()] == saved
    before = spark.createDataFrame([(1, Decimal(5), 7, 9, False, 0)], PROGRESS_SCHEMA)
    assert [tuple(r) for r in bridge.progress_row(enriched, before).collect()] == saved
    assert [tuple(r) for r in bridge.progress_row(enriched.filter("run < 0"), before).collect()] == [(1, 5, 7, 9, False)]


def test_logs_of_a_batch_are_read_once(spark, tmp_path, monkeypatch):
    """The plan that numbers the logs of a batch holds their JSON once, and the numbers of their messages."""
    plans = []
    monkeypatch.setattr(bridge, "parse_body", lambda rows: plans.append(rows._jdf.queryExecution().withCachedData().toString()) or parse_body(rows))
    put(str(tmp_path / "in"), "a.txt", message(log(1), log(2)), message(log(3)))
    process_bridge_batch(read_tick_stream(spark, str(tmp_path / "in")), 0, BridgeTables(str(tmp_path / "out")), METHOD)
    assert plans and "from_json" not in plans[0].split("InMemoryRelation")[0]
    assert read_events(spark, BridgeTables(str(tmp_path / "out")).events).count() == 3


def test_tick_cut_by_a_batch(spark, tmp_path):
    start = {"customMessage": "6217575821008262227"}
    tables = BridgeTables(str(tmp_path / "out"))
    process_bridge_batch(lines(spark, message(log(1), log(2, type=255, body=start), log(3))), 0, tables, METHOD)
    second = lines(spark, message(log(4), log(5)), message(log(6, tick=11), tick=11))
    for _ in range(2):  # the second batch runs twice
        process_bridge_batch(second, 1, tables, METHOD)
    got = [(int(r["log_id"]), r["index_in_tick"]) for r in read_events(spark, tables.events).orderBy("log_id").collect()]
    assert got == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4), (6, 0)]
    values = {v["logId"]: v.get("dividend", False) for v in (json.loads(r["value"]) for r in spark.read.text(tables.topic).collect())}
    assert values == {1: False, 2: False, 3: True, 4: True, 5: True, 6: False}
    # A batch without logs keeps the progress.
    process_bridge_batch(lines(spark, message(catchUpComplete=True)), 2, tables, METHOD)
    assert start_position(spark, tables, initial_tick=1).first()[0] == 12
    assert start_position(spark, tables, initial_tick=1, override_tick=5).first()[0] == 5


def test_resent_events_are_overwritten(spark, tmp_path):
    tables = BridgeTables(str(tmp_path / "out"))
    process_bridge_batch(lines(spark, message(log(1), log(2))), 0, tables, METHOD)
    process_bridge_batch(lines(spark, message(log(1, txHash="new"), log(2), log(3))), 1, tables, METHOD)
    rows = read_events(spark, tables.events).orderBy("log_id").collect()
    # The last tick goes on at its next index, also for logs that came before.
    assert [(int(r["log_id"]), r["tx_hash"], r["index_in_tick"]) for r in rows] == [(1, "new", 2), (2, "", 3), (3, "", 4)]
    compact_events(spark, tables.events, str(tmp_path / "compact"))
    assert events_of(read_events(spark, str(tmp_path / "compact"))) == events_of(read_events(spark, tables.events))


def test_lookups_reach_the_files(spark, tmp_path):
    tables = BridgeTables(str(tmp_path / "out"))
    process_bridge_batch(lines(spark, message(log(1), log(2)), message(log(3, tick=11), tick=11)), 0, tables, METHOD)
    found = events_in_range(read_events(spark, tables.events), 1, 11, 12)
    assert [int(r["log_id"]) for r in found.collect()] == [3]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(epoch" in plan
    assert "GreaterThanOrEqual(tick,11), LessThanOrEqual(tick,12)" in plan
    assert "Window" not in plan  # one run: no key can stand in it twice
    # Where runs share ticks their keys are compared, above the filters.
    process_bridge_batch(lines(spark, message(log(4, tick=12), log(3, tick=11, txHash="new"), tick=12)), 1, tables, METHOD)
    found = events_in_range(read_events(spark, tables.events), 1, 11, 12)
    assert [(int(r["log_id"]), r["tx_hash"]) for r in found.collect()] == [(3, "new"), (4, "")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "GreaterThanOrEqual(tick,11), LessThanOrEqual(tick,12)" in plan


def test_start_tick_and_errors(spark, tmp_path):
    bad = log(2, body={"from": 5})
    tables = BridgeTables(str(tmp_path / "strict"))
    with pytest.raises(BadRecords, match="from"):
        process_bridge_batch(lines(spark, message(log(1), bad)), 0, tables, METHOD)
    with pytest.raises(BadRecords, match="malformed"):
        process_bridge_batch(lines(spark, "{"), 0, tables, METHOD)
    assert not os.path.exists(tables.root)  # nothing was written
    tables = BridgeTables(str(tmp_path / "quarantine"))
    process_bridge_batch(lines(spark, message(log(1), bad), "{broken", message(log(3, tick=9), tick=9)), 0, tables, METHOD, start_tick=10, mode="quarantine")
    assert [int(r["log_id"]) for r in read_events(spark, tables.events).collect()] == [1]
    errors = spark.read.parquet(tables.errors).collect()
    assert {(r["reason"], r["log_id"], r["text"]) for r in errors} == {("from", 2, '{"from":5}'), ("malformed message", None, "{broken")}


def test_restart_after_a_failed_batch(spark, tmp_path):
    """The first run dies on its second file; the next run takes it from there."""
    root = str(tmp_path / "out")
    put(str(tmp_path / "in"), "0.txt", message(log(1), log(2)), at=1_700_000_000)
    put(str(tmp_path / "in"), "1.txt", message(log(3)), at=1_700_000_001)
    seen = []

    def publish(rows, batch):
        seen.append(batch)
        if seen == [0, 1]:
            raise RuntimeError("broker is gone")
        BridgeTables(root).publish(rows, batch)

    def run():
        stream = read_tick_stream(spark, str(tmp_path / "in"), streaming=True, max_files=1)
        run_bridge(stream, root, f"{root}/checkpoint", METHOD, publish=publish).awaitTermination()

    with pytest.raises(Exception, match="broker is gone"):
        run()
    assert read_events(spark, BridgeTables(root).events).count() == 2
    run()
    assert seen == [0, 1, 1]
    rows = read_events(spark, BridgeTables(root).events).orderBy("log_id").collect()
    assert [(int(r["log_id"]), r["index_in_tick"]) for r in rows] == [(1, 0), (2, 1), (3, 2)]


# ------------------------------------------------------------------ index and replay


def test_index_stream_equals_batch(spark, tmp_path):
    values = feeds.topic_e(spark, SF).select("value")
    values.repartition(5).write.text(str(tmp_path / "in"))
    root = str(tmp_path / "out")
    stream = read_event_ndjson(spark, str(tmp_path / "in"), streaming=True, max_files=2)
    run_index(stream, root, f"{root}/checkpoint", mode="quarantine").awaitTermination()
    routed = feeds.routed_e(spark, SF)
    expected = {(r["epoch"], int(r["logId"]), r["logType"]) for r in routed.filter("status = 'processed'").collect()}
    got = read_documents(spark, IndexTables(root).documents)
    assert {(r["epoch"], int(r["logId"]), r["logType"]) for r in got.collect()} == expected
    assert spark.read.parquet(IndexTables(root).errors).count() == routed.filter("status = 'failed'").count()


def test_index_strict_and_switch(spark, tmp_path):
    put(str(tmp_path / "in"), "a.txt", '{"epoch":1}')
    root = str(tmp_path / "out")
    with pytest.raises(Exception, match="missing tickNumber"):
        run_index(read_event_ndjson(spark, str(tmp_path / "in"), streaming=True), root, f"{root}/cp").awaitTermination()
    assert not os.path.exists(IndexTables(root).documents)
    run_index(
        read_event_ndjson(spark, str(tmp_path / "in"), streaming=True), root, f"{root}/cp2", mode="quarantine", tick_status=False
    ).awaitTermination()
    assert not os.path.exists(IndexTables(root).counters)
    assert read_highest_tick(spark, IndexTables(root)).first() is None


def test_replay(spark):
    stored = to_stored_event(feeds.enriched_e(spark, SF))
    taken = []
    run_replay(stored, lambda rows, batch: taken.append(rows), epoch=2)
    values = [json.loads(r["value"]) for r in taken[0].collect()]
    assert len(values) == stored.filter("epoch = 2").count()
    assert all(v["bodySize"] == 0 and "dividend" not in v for v in values)
    live = {v["logId"]: v for v in (json.loads(r["value"]) for r in feeds.topic_e(spark, SF).collect())}
    for v in values:
        assert v["body"] == live[v["logId"]]["body"] and v["index"] == live[v["logId"]]["index"]
    one = stored.filter("epoch = 2").agg(F.min("tick")).first()[0]
    run_replay(stored, lambda rows, batch: taken.append(rows), epoch=2, start=one, end=one)
    assert {r["tick"] for r in taken[1].collect()} == {one}
    with pytest.raises(ValueError):
        run_replay(stored, lambda rows, batch: None, epoch=2, start=5, end=4)
    unknown = stored.limit(1).withColumns({"event_type": F.lit(77).cast("bigint"), "body": F.lit('{"hex":""}'), "epoch": F.lit(2).cast("bigint")})
    with pytest.raises(BadRecords, match="77"):
        run_replay(unknown, lambda rows, batch: taken.append(rows), epoch=2)
    assert len(taken) == 2


# ------------------------------------------------------------------ what grows with shuffle partitions


def test_kept_logs_lie_in_few_partitions(spark, tmp_path):
    """However many partitions a shuffle has, a batch is kept in about as many as there are cores."""
    put(str(tmp_path / "in"), "a.json", *[message(log(i), log(i + 1), tick=10 + i) for i in range(0, 20, 2)])
    partitions = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = read_tick_stream(spark, str(tmp_path / "in"))
        process_bridge_batch(rows, 0, BridgeTables(str(tmp_path / "out")), METHOD, publish=lambda topic, _: partitions.append(topic.rdd.getNumPartitions()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert partitions == [3 * spark.sparkContext.defaultParallelism]
    assert read_events(spark, str(tmp_path / "out" / "events")).count() == 20
