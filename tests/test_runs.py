import os
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tickflow.operators.events import events_for_tick, has_events
from tickflow.operators.status import epoch_status
from tickflow.sinks.runs import RunTable
from tickflow.sinks.tables import events_table

SCHEMA = "epoch BIGINT, tick BIGINT, log_id BIGINT, text STRING"


def table(spark, path, fan_in=8):
    return RunTable(spark, str(path), SCHEMA, ("epoch", "tick", "log_id"), lookup="log_id", fan_in=fan_in)


def rows(spark, *values):
    return spark.createDataFrame([(*v, i) for i, v in enumerate(values)], SCHEMA + ", at BIGINT")


def content(frame):
    return sorted(map(tuple, frame.collect()))


def parquet_files(path):
    return [os.path.join(d, f) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet")]


def test_fifty_batches_leave_few_files(spark, tmp_path):
    """An epoch that stays open, resent rows among the new ones, one epoch change: files stay bounded, and nothing is lost."""
    runs, expected, most = table(spark, tmp_path / "t", fan_in=4), {}, 0
    chance = random.Random(1)
    for batch in range(50):
        epoch = 1 if batch < 30 else 2
        values = [(epoch, batch, 10 * batch + i, f"b{batch}") for i in range(3)]
        if batch % 7 == 3:
            old = chance.choice(sorted(expected))
            values += [(*old, f"again{batch}"), (*old, f"last{batch}")]
        for e, t, i, text in values:
            expected[e, t, i] = text
        runs.append(rows(spark, *values), batch, "at")
        version = runs.version()
        assert version.batch == batch
        most = max(most, max(sum(r.epoch == e for r in version.runs) for e in {r.epoch for r in version.runs}))
    assert most <= 3 * 3 + 3  # three levels below four runs each
    assert content(runs.read()) == sorted((*k, v) for k, v in expected.items())
    assert len([r for r in runs.version().runs if r.epoch == 1]) <= 4  # closed when epoch 2 began; some rows were resent later
    # Folders of merged runs are gone, but for those that the list before named.
    assert len(parquet_files(tmp_path / "t")) <= 60
    status = {r["epoch"]: (r["first_tick"], r["last_tick"], r["total_events"]) for r in runs.status().collect()}
    assert status == {e: (min(t for f, t, _ in expected if f == e), max(t for f, t, _ in expected if f == e), sum(f == e for f, _, _ in expected)) for e in (1, 2)}


def test_a_batch_that_dies_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    runs = table(spark, tmp_path / "t", fan_in=2)
    runs.append(rows(spark, (1, 1, 1, "a"), (1, 2, 2, "b")), 0, "at")
    before = content(runs.read())

    def killed(self, version):
        raise RuntimeError("killed")

    second = rows(spark, (1, 2, 2, "c"), (1, 3, 3, "d"))
    with monkeypatch.context() as m:
        m.setattr(RunTable, "_switch", killed)
        with pytest.raises(RuntimeError):
            runs.append(second, 1, "at")  # the run and the merge of both runs are written, the list is not
    assert {"run=0", "run=2", "run=3"} <= set(os.listdir(tmp_path / "t"))
    assert content(runs.read()) == before
    assert content(runs.status()) == [(1, 1, 2, 2)]
    for _ in range(2):  # it runs again, and again
        runs.append(second, 1, "at")
        assert content(runs.read()) == [(1, 1, 1, "a"), (1, 2, 2, "c"), (1, 3, 3, "d")]
        assert content(runs.status()) == [(1, 1, 3, 3)]
        assert content(runs.status(delivered=True)) == [(1, 1, 3, 4)]
    assert len(runs.version().runs) == 1


def test_retention_keeps_its_mark(spark, tmp_path):
    runs = table(spark, tmp_path / "t")
    for batch, epoch in enumerate([3, 5, 4, 8]):
        runs.append(rows(spark, (epoch, batch, batch, "x")), batch, "at", keep_epochs=2)
    assert runs.version().dropped == 4
    assert content(runs.read()) == [(5, 1, 1, "x"), (8, 3, 3, "x")]
    # A batch without rows keeps list and mark; so does another session's table.
    runs.append(rows(spark), 4, "at", keep_epochs=2)
    assert table(spark, tmp_path / "t").version().dropped == 4
    assert {r.epoch for r in runs.version().runs} == {5, 8}
    assert os.path.isdir(tmp_path / "t" / "run=0" / "epoch=3")  # left for an archive
    runs.clean(dropped_epochs=True)
    assert not os.path.isdir(tmp_path / "t" / "run=0")
    assert content(runs.read()) == [(5, 1, 1, "x"), (8, 3, 3, "x")]


def test_empty_table(spark, tmp_path):
    runs = table(spark, tmp_path / "t")
    assert runs.read().count() == 0 and runs.status().count() == 0 and runs.version().batch == -1
    assert runs.read_for(spark.createDataFrame([(1,)], "tick BIGINT")).count() == 0
    runs.append(rows(spark), 0, "at")
    assert runs.read().count() == 0 and runs.version().batch == 0


def test_runs_of_other_spans_are_not_compared(spark, tmp_path):
    """Batches that share their ticks but no log id; then one that shares both, and one whose ids are not all known."""
    runs = replace(table(spark, tmp_path / "t"), span="log_id")
    runs.append(rows(spark, (1, 1, 1, "a"), (1, 2, 2, "b")), 0, "at")
    runs.append(rows(spark, (1, 1, 11, "c"), (1, 2, 12, "d")), 1, "at")
    assert "Window" not in runs.read()._jdf.queryExecution().optimizedPlan().toString()
    whole = [(1, 1, 1, "a"), (1, 1, 11, "c"), (1, 2, 2, "b"), (1, 2, 12, "d")]
    assert content(runs.read()) == whole and content(runs.status()) == [(1, 1, 2, 4)]
    runs.append(rows(spark, (1, 1, 11, "again"), (1, 2, 13, "e")), 2, "at")
    whole = [(1, 1, 1, "a"), (1, 1, 11, "again"), (1, 2, 2, "b"), (1, 2, 12, "d"), (1, 2, 13, "e")]
    assert content(runs.read()) == whole and content(runs.status()) == [(1, 1, 2, 5)] and content(runs.status(delivered=True)) == [(1, 1, 2, 6)]
    runs.append(spark.createDataFrame([(1, 2, None, "f", 0), (1, 2, 2, "last", 1)], SCHEMA + ", at BIGINT"), 3, "at")
    assert runs.version().runs[-1].first_span is None
    assert {r["log_id"]: r["text"] for r in runs.read().collect()} == {1: "a", 11: "again", 2: "last", 12: "d", 13: "e", None: "f"}
    assert content(runs.status()) == [(1, 1, 2, 6)]


def test_known_keys_do_not_pass_through_the_driver(spark, tmp_path, monkeypatch):
    runs, joined = replace(table(spark, tmp_path / "t"), span="log_id"), []
    frames = type(spark.range(1))
    join = frames.join
    runs.append(rows(spark, *[(1, 1, i, "a") for i in range(50)]), 0, "at")
    monkeypatch.setattr(frames, "join", lambda self, *a, **k: joined.append(join(self, *a, **k)) or joined[-1])
    runs.append(rows(spark, *[(1, 1, i, "b") for i in range(25, 75)]), 1, "at")
    assert joined and all("BroadcastHashJoin" not in j._jdf.queryExecution().executedPlan().toString() for j in joined)
    assert content(runs.status()) == [(1, 1, 1, 75)]


def test_lookups_open_a_bounded_share_of_the_files(spark, tmp_path):
    """Of 24 runs over ticks of their own a lookup opens the one that can hold its tick."""
    events = events_table(spark, str(tmp_path / "events"))
    make = lambda batch: spark.range(200).selectExpr(
        f"1L + {batch} div 12 as epoch", f"{batch} * 100 + id div 2 as tick", "cast(id as decimal(20,0)) log_id", "0L event_type", "'' tx_hash",
        "1L timestamp", "'{}' body", "id as index_in_tick", "'d' log_digest", "true last_log_for_tick",
    )
    whole = None
    for batch in range(24):
        events.append(make(batch), batch, "index_in_tick")
        whole = make(batch) if whole is None else whole.union(make(batch))
    every = len(events.read().inputFiles())
    wanted = spark.createDataFrame([(2350,)], "tick BIGINT")
    one = events.read_for(wanted)
    assert len(one.inputFiles()) <= max(1, every // 6)
    assert content(events_for_tick(one, 2350)) == content(events_for_tick(whole, 2350))
    keys = spark.createDataFrame([(2, 2310, 20), (2, 2310, 77), (1, 2310, 20), (9, 5, 5)], "epoch BIGINT, tick BIGINT, log_id BIGINT").withColumn("log_id", F.col("log_id").cast("decimal(20,0)"))
    held = events.read_for(keys)
    assert len(held.inputFiles()) <= max(1, every // 6)
    assert content(has_events(held, keys)) == content(has_events(whole, keys))
    assert [r["present"] for r in has_events(held, keys).orderBy("epoch", "log_id").collect()] == [False, True, False, False]
    assert content(events.status()) == content(epoch_status(whole))
