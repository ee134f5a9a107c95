from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickflow.operators import ticks as tk
from tickflow.sinks.tables import COUNTER_SCHEMA, newest_state
from tickflow.streaming.index import IndexTables, read_highest_tick, update_tick_height


def routed(spark, rows):
    """rows: (tick, status, index, last)."""
    return spark.createDataFrame(rows, "tickNumber bigint, status string, index bigint, lastLogForTick boolean").withColumn(
        "epoch", F.lit(1)
    )


P, S, X = "processed", "skipped", "failed"


@pytest.mark.parametrize(
    ("total", "processed", "skipped", "complete"),
    [
        (0, 0, 0, False), (10, 5, 0, False), (10, 0, 5, False), (10, 5, 4, False),
        (10, 10, 0, True), (10, 0, 10, True), (10, 5, 5, True), (10, 6, 5, True),
    ],
)
def test_completeness(spark, total, processed, skipped, complete):
    row = spark.createDataFrame([(total, processed, skipped)], "total int, processed int, skipped int")
    assert row.select(tk.is_complete()).first()[0] is complete


def test_counters_and_height(spark):
    rows = [(1000, P, 0, False), (1000, S, 1, False), (1000, P, 2, True), (1001, S, 0, True), (1002, X, 0, True), (1003, P, 0, False)]
    got = {r["tick"]: tuple(r)[1:] for r in tk.tick_status(routed(spark, rows)).collect()}
    assert got == {1000: (2, 1, 3, True), 1001: (0, 1, 1, True), 1003: (1, 0, 0, False)}
    # 1001 is complete, but nothing of it was processed.
    assert tuple(tk.highest_tick(tk.tick_counters(routed(spark, rows))).first()) == (1000, 2)
    assert tk.highest_tick(tk.tick_counters(routed(spark, rows[3:]))).first() is None
    assert tuple(tk.batch_totals(routed(spark, rows)).first()) == (6, 3)
    assert tuple(tk.indexed_height(routed(spark, rows)).first()) == (1003, 1)


def test_redelivery(spark):
    rows = routed(spark, [(1, P, 0, False), (1, P, 0, False), (1, P, 1, True)])
    assert tk.tick_status(rows).first()["processed"] == 3
    assert tk.tick_status_exact(rows, ["tickNumber", "index"], "index").first()["processed"] == 2


def _state(spark, tables):
    return {r["tick"]: (r["processed"], r["skipped"], r["total"]) for r in newest_state(spark, tables.counters, COUNTER_SCHEMA).collect()}


def test_height_over_batches(spark, tmp_path):
    tables = IndexTables(str(tmp_path))

    def send(batch, *rows):
        update_tick_height(routed(spark, list(rows)), tables, batch)
        row = read_highest_tick(spark, tables).first()
        return row and tuple(row)

    assert send(0, (1000, P, 0, False), (1000, S, 1, False)) is None
    assert send(1, (1000, P, 2, True)) == (1000, 2)
    assert send(2, (1001, S, 0, False), (1001, S, 1, False), (1001, P, 2, True), (1002, P, 0, False)) == (1001, 1)
    assert _state(spark, tables) == {1001: (1, 2, 3), 1002: (1, 0, 0)}  # 1000 is gone
    # Late and repeated ticks no longer count; higher ones do.
    assert send(3, (1000, P, 0, True), (1001, P, 0, True), (1002, S, 1, False)) == (1001, 1)
    assert _state(spark, tables) == {1001: (1, 2, 3), 1002: (1, 1, 0)}
    # The same batch once more starts from the same state.
    assert send(3, (1000, P, 0, True), (1001, P, 0, True), (1002, S, 1, False)) == (1001, 1)
    assert _state(spark, tables) == {1001: (1, 2, 3), 1002: (1, 1, 0)}
    # A complete tick above incomplete ones takes the lead.
    assert send(4, (1005, P, 0, True)) == (1005, 1)
    assert _state(spark, tables) == {1005: (1, 0, 1)}


def test_prune_and_above(spark):
    frame = spark.createDataFrame([(90,), (100,), (110,)], "tick bigint")
    assert [r[0] for r in tk.prune_ticks(frame, 105).collect()] == [110]
    assert [r[0] for r in tk.prune_ticks(frame, 100).collect()] == [100, 110]
    assert [r[0] for r in tk.above(frame, 100).collect()] == [110]
    assert tk.above(frame, None).count() == tk.prune_ticks(frame, None).count() == 3


def test_a_later_total_replaces_the_old_one(spark):
    schema = "tick bigint, processed bigint, skipped bigint, total bigint"
    state = spark.createDataFrame([(1, 1, 0, 5), (2, 1, 0, 5), (3, 1, 1, 2)], schema)
    delta = spark.createDataFrame([(1, 1, 1, 0), (2, 0, 1, 3), (4, 1, 0, 1)], schema)
    got = sorted(tuple(r) for r in tk.merge_counters(state, delta).collect())
    assert got == [(1, 2, 1, 5), (2, 1, 1, 3), (3, 1, 1, 2), (4, 1, 0, 1)]


def test_unsigned_ticks_and_indices(spark):
    top = 2**64 - 1
    rows = [("processed", Decimal(top), Decimal(top), True), ("skipped", Decimal(2**63), Decimal(0), True), ("processed", Decimal(2**63), Decimal(1), False)]
    routed = spark.createDataFrame(rows, "status string, tickNumber decimal(20,0), index decimal(20,0), lastLogForTick boolean")
    got = {int(r.tick): (r.processed, r.skipped, int(r.total)) for r in tk.tick_counters(routed).collect()}
    assert got == {top: (1, 0, 2**64), 2**63: (1, 1, 1)}
    assert int(tk.highest_tick(tk.tick_status(routed)).first()["tick"]) == 2**63
    merged = tk.merge_counters(tk.tick_counters(routed), tk.tick_counters(routed))
    assert {int(r.tick): r.processed for r in merged.collect()} == {top: 2, 2**63: 2}
