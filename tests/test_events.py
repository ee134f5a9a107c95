import random

import pytest
from pyspark.sql import functions as F

from tickflow.operators import events as ev
from tickflow.operators import status as st
from tickflow.operators.metrics import replay_progress, replay_totals
from tickflow.sinks.files import in_topic_order


@pytest.fixture(scope="module")
def stored(spark):
    rows = [(1, 10, 1, 0), (1, 10, 2, 1), (1, 14, 3, 0), (2, 20, 1, 0), (2, 21, 2, 0), (3, 20, 9, 0), (3, 30, 10, 0), (3, 30, 11, 1)]
    return spark.createDataFrame(rows, "epoch bigint, tick bigint, log_id bigint, index_in_tick bigint").cache()


def ids(frame):
    return [r["log_id"] for r in frame.collect()]


def test_ranges(stored):
    assert ids(ev.scan_events(stored, 1)) == [1, 2, 3]
    assert ids(ev.events_in_range(stored, 1, 10, 10)) == [1, 2]
    assert ids(ev.events_in_range(stored, 1, 11, 0)) == [3]
    assert ids(ev.events_in_range(stored, 1, 0, 13)) == [1, 2]
    assert ids(ev.events_in_range(stored, 9)) == []
    with pytest.raises(ValueError):
        ev.events_in_range(stored, 1, 5, 4)


def test_tick_lookup(spark, stored):
    assert ids(ev.events_for_tick(stored, 10)) == [1, 2]
    assert ids(ev.events_for_tick(stored, 20)) == [1]  # in epochs 2 and 3: the lowest
    assert ids(ev.events_for_tick(stored, 99)) == []
    with pytest.raises(ValueError):
        ev.events_for_tick(stored, 0)
    ticks = spark.createDataFrame([(10,), (12,), (20,), (25,), (99,)], "tick bigint")
    assert {r["tick"]: r["epoch"] for r in ev.tick_to_epoch(stored, ticks).collect()} == {10: 1, 12: 1, 20: 2, 25: 3}
    got = sorted((r["tick"], r["epoch"], r["log_id"] or 0) for r in ev.events_for_ticks(stored, ticks).collect())
    assert got == [(10, 1, 1), (10, 1, 2), (12, 1, 0), (20, 2, 1), (25, 3, 0), (99, 0, 0)]


def _lowest(ranges, tick):
    return min((e for e, first, last in ranges if first <= tick <= last), default=None)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_covering_ranges_against_a_scan(spark, seed):
    chance = random.Random(seed)
    ranges = []
    for epoch in chance.sample(range(1000), 40):
        first = chance.randrange(60_000)
        ranges.append((epoch, first, first + chance.choice([0, 5, 3000, 20_000])))
    ticks = sorted({t for _, a, b in ranges for t in (a - 1, a, b, b + 1)} | set(chance.sample(range(90_000), 500)))
    frame = spark.createDataFrame(ranges, "epoch bigint, first_tick bigint, last_tick bigint")
    got = {r["tick"]: r["epoch"] for r in ev.covering(frame, spark.createDataFrame([(t,) for t in ticks], "tick bigint")).collect()}
    assert got == {t: e for t in ticks if (e := _lowest(ranges, t)) is not None}
    segments = sorted(tuple(r) for r in ev.range_segments(frame).collect())
    assert all(a[1] < b[0] for a, b in zip(segments, segments[1:]))
    assert len(segments) <= 2 * len(ranges)


def test_overlapping_epochs_do_not_multiply_rows(spark):
    """300 epochs over the same 10,000 ticks: a tick meets one segment, not 300."""
    ranges = spark.range(300).selectExpr("id epoch", "id first_tick", "10000 + id last_tick")
    wanted = spark.range(9000).selectExpr("id + 500 tick")
    assert ev.range_segments(ranges).count() <= 600
    found = ev.covering(ranges, wanted)
    assert found.filter("epoch = 0").count() == 9000
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    empty = ranges.limit(0)
    assert ev.covering(empty, wanted).count() == 0 and ev.range_segments(empty).count() == 0


def test_topic_order_keeps_ticks_whole(spark):
    """300 ordinary ticks and one hot one over eight tasks: only the hot one lies in several."""
    rows = spark.range(300).selectExpr("id tick", "explode(sequence(0L, 5 + id % 40)) index")
    rows = rows.union(spark.range(6000).selectExpr("150L tick", "id + 100 index")).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = in_topic_order(rows, tick_rows=1000).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    tasks = {}
    for r in placed:
        tasks.setdefault(r["tick"], set()).add(r["task"])
    assert all(len(t) == 1 for tick, t in tasks.items() if tick != 150) and len(tasks[150]) > 1
    assert len({r["task"] for r in placed}) == 4
    order = [(r["task"], r["tick"], r["index"]) for r in placed]
    assert order == sorted(order) and [x[1:] for x in order] == sorted(x[1:] for x in order)


def test_existence_and_counts(spark, stored):
    keys = spark.createDataFrame([(1, 10, 1), (1, 10, 3), (9, 10, 1), (1, 10, 1)], "epoch bigint, tick bigint, log_id bigint")
    got = sorted((r["epoch"], r["log_id"], r["present"]) for r in ev.has_events(stored, keys).collect())
    assert got == [(1, 1, True), (1, 1, True), (1, 3, False), (9, 1, False)]
    assert ev.has_event(stored, 3, 30, 11)
    assert not ev.has_event(stored, 2, 30, 11)
    assert st.count_events_for_tick(stored, 3, 30).first()[0] == 2
    assert st.count_events_for_tick(stored, 9, 30).first()[0] == 0
    assert tuple(st.epoch_tick_range(stored, 3).first()) == (3, 20, 30)
    assert st.epoch_tick_range(stored, 9).first() is None


def test_last_write_wins(spark):
    old = spark.createDataFrame([(1, 1, 1, "a"), (1, 1, 2, "b")], "epoch int, tick int, log_id int, v string")
    new = spark.createDataFrame([(1, 1, 2, "B"), (1, 1, 3, "C")], old.schema)
    got = sorted((r["log_id"], r["v"]) for r in ev.upsert_events(old, new).collect())
    assert got == [(1, "a"), (2, "B"), (3, "C")]
    rows = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id"))
    assert sorted(r["id"] for r in ev.latest_by_key(rows, ["k"], "id").collect()) == [98, 99]
    plan = ev.latest_by_key(rows, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # once before the shuffle, once after


def test_retention(spark):
    stored = spark.createDataFrame([(e,) for e in (1, 2, 5, 6, 7)], "epoch bigint")
    assert sorted(r[0] for r in ev.retain_epochs(stored, 3).collect()) == [5, 6, 7]
    assert ev.retain_epochs(stored, 0).count() == 5
    assert [r[0] for r in ev.kept_epochs(stored, 2).collect()] == [7, 6]
    incoming = spark.createDataFrame([(e,) for e in (1, 2, 3, 5, 8)], "epoch bigint")
    scope = {r["epoch"]: r["in_scope"] for r in ev.epoch_scope(stored, incoming, 3).collect()}
    assert scope == {1: False, 2: False, 3: True, 5: True, 8: True}  # 2 is the highest one dropped
    assert all(r["in_scope"] for r in ev.epoch_scope(stored, incoming, 9).collect())
    assert all(r["in_scope"] for r in ev.epoch_scope(stored, incoming, 0).collect())
    with pytest.raises(ev.EpochOutOfScope):
        ev.reject_out_of_scope(ev.epoch_scope(stored, incoming, 3))
    assert ev.reject_out_of_scope(ev.epoch_scope(stored, incoming, 5)).columns == ["epoch"]


def test_status(spark, stored):
    row = st.service_status(stored).first()
    assert [(e["epoch"], e["intervals"][0]["firstTick"], e["intervals"][0]["lastTick"], e["totalEvents"]) for e in row["epochs"]] == [
        (1, 10, 14, 3), (2, 20, 21, 2), (3, 20, 30, 3),
    ]
    assert tuple(row)[1:] == (3, 30, 11)
    empty = st.service_status(stored.filter("false")).first()
    assert empty["epochs"] == [] and empty["current_epoch"] is None
    assert [r[0] for r in st.available_epochs(stored).collect()] == [1, 2, 3]


def test_status_counts_resent_keys_once_or_as_delivered(spark):
    rows = spark.createDataFrame([(1, 5, 1, 0), (1, 5, 1, 1), (1, 4, 2, 2)], "epoch int, tick int, log_id int, arrival int")
    assert tuple(st.epoch_status(rows, "arrival").first()) == (1, 4, 5, 2)
    assert tuple(st.epoch_status_delivered(rows).first()) == (1, 4, 5, 3)


def test_start_position(spark, stored):
    saved = st.progress(stored)
    assert st.resume_from(saved, 7).first()[0] == 31
    assert st.resume_from(saved, 7, override_tick=3).first()[0] == 3
    assert st.resume_from(saved.filter("false"), 7).first()[0] == 7


def test_replay_progress(spark):
    messages = spark.range(1000).select((F.col("id") % 250 + 5000).alias("tickNumber"))
    assert tuple(replay_totals(messages).first()) == (1000, 250)
    got = sorted(tuple(r) for r in replay_progress(messages).collect())
    assert got == [(100, 400, 5099), (200, 800, 5199)]
    assert tuple(replay_totals(messages.filter("false")).first()) == (0, 0)
