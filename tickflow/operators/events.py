"""Stored events: last write per key, lookups, ranges, retention and scope."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickflow.scratch import written

EVENT_KEY = ["epoch", "tick", "log_id"]
#: Ticks per bucket when single ticks are looked up in tick ranges (as a power of two).
RANGE_BITS = 12


class EpochOutOfScope(ValueError):
    """A strict write met epochs that retention has put out of scope."""


def latest_by_key(rows: DataFrame, keys: list[str], *arrival: str) -> DataFrame:
    """The last arrived row of every key.

    Written as ``row_number() = 1`` because Spark turns that into a group
    limit that runs before the shuffle too: a key resent a billion times
    leaves every map task as one row.
    """
    order = Window.partitionBy(*keys).orderBy(*[F.col(a).desc() for a in arrival])
    return rows.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank")


def upsert_events(stored: DataFrame, incoming: DataFrame, keys: list[str] = EVENT_KEY) -> DataFrame:
    """``stored`` with ``incoming`` put over it, by key; ``incoming`` has one row per key."""
    both = stored.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    return latest_by_key(both, keys, "__new").drop("__new")


def _check_tick(tick: int) -> None:
    if tick <= 0:
        raise ValueError("tick must be greater than 0")


def in_range(start: int, end: int) -> Column:
    """``start <= tick <= end``; 0 leaves a side open."""
    if start < 0 or end < 0:
        raise ValueError("ticks must not be negative")
    if end and end < start:
        raise ValueError(f"end tick {end} is below start tick {start}")
    condition = F.lit(True)
    if start:
        condition = condition & (F.col("tick") >= start)
    if end:
        condition = condition & (F.col("tick") <= end)
    return condition


def scan_events(events: DataFrame, epoch: int) -> DataFrame:
    """All events of an epoch in key order."""
    return events.filter(F.col("epoch") == epoch).orderBy("tick", "log_id")


def events_in_range(events: DataFrame, epoch: int, start: int = 0, end: int = 0) -> DataFrame:
    """Events of an epoch with ``start <= tick <= end``, in key order; 0 leaves a side open."""
    return events.filter((F.col("epoch") == epoch) & in_range(start, end)).orderBy("tick", "log_id")


def tick_to_epoch(events: DataFrame, ticks: DataFrame) -> DataFrame:
    """Distinct ``tick`` values -> the lowest ``epoch`` that holds events of the tick.

    Ticks without events take the lowest epoch whose tick range covers them;
    other ticks get no row.
    """
    exact, covered = _epochs_of(events, ticks.select("tick").distinct())
    return exact.unionByName(covered)


def _epochs_of(events: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Epochs of the ticks that hold events, and of those that only lie in an epoch's range.

    Events are reduced to one row per epoch and tick before anything else looks at them.
    """
    held = written(events.groupBy("epoch", "tick").agg(F.count(F.lit(1)).alias("n")).select("epoch", "tick"), "held")
    exact = held.groupBy("tick").agg(F.min("epoch").alias("epoch")).join(wanted, "tick").select("tick", "epoch")
    rest = wanted.join(exact, "tick", "left_anti")
    return exact, covering(epoch_ranges(held), rest)


def range_segments(ranges: DataFrame) -> DataFrame:
    """Ranges (epoch, first_tick, last_tick) that may overlap -> disjoint segments (start, end, epoch) with the lowest epoch
    that covers them. Epochs are 16-bit numbers, so one task sweeps over 65,536 ranges at most."""
    schema = "start BIGINT, end BIGINT, epoch BIGINT"
    return ranges.select("first_tick", "last_tick", "epoch").repartition(1).mapInArrow(_sweep, schema)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the left to the right over all ends of ranges, with the ranges begun so far in a heap by epoch."""
    ranges = sorted(row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("first_tick", "last_tick", "epoch"))))
    cuts = sorted({cut for first, last, _ in ranges for cut in (first, last + 1)})
    begun: list[tuple[int, int]] = []
    out: list[tuple[int, int, int]] = []
    at = 0
    for start, after in zip(cuts, cuts[1:]):
        while at < len(ranges) and ranges[at][0] <= start:
            heapq.heappush(begun, (ranges[at][2], ranges[at][1]))
            at += 1
        while begun and begun[0][1] < start:
            heapq.heappop(begun)
        if begun:
            epoch = begun[0][0]
            if out and out[-1][2] == epoch and out[-1][1] == start - 1:
                out[-1] = (out[-1][0], after - 1, epoch)
            else:
                out.append((start, after - 1, epoch))
    columns = zip(*out) if out else ([], [], [])
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["start", "end", "epoch"])


def covering(ranges: DataFrame, wanted: DataFrame) -> DataFrame:
    """Distinct ``tick`` values -> the lowest ``epoch`` whose range covers them; ticks outside all ranges get no row.

    Segments are cut at every 2^12 ticks. Inside such a bucket, ticks and the starts of segments stand in one order, and a tick
    takes the last segment before it: rows grow with the ticks and the segments, however many ranges overlap.
    """
    segments = range_segments(ranges).withColumn(
        "bucket", F.explode(F.sequence(F.shiftright("start", RANGE_BITS), F.shiftright("end", RANGE_BITS)))
    )
    starts = segments.select(
        "bucket", F.greatest("start", F.shiftleft("bucket", RANGE_BITS)).alias("tick"), F.struct("end", "epoch").alias("segment")
    )
    asked = wanted.select(F.shiftright("tick", RANGE_BITS).alias("bucket"), "tick", F.lit(None).cast("struct<end: bigint, epoch: bigint>").alias("segment"))
    both = starts.withColumn("wanted", F.lit(0)).unionByName(asked.withColumn("wanted", F.lit(1)))
    before = "last(segment, true) over (partition by bucket order by tick, wanted rows between unbounded preceding and current row)"
    return both.selectExpr("tick", "wanted", f"{before} found").filter("wanted = 1 and tick <= found.end").selectExpr("tick", "found.epoch epoch")


def events_for_tick(events: DataFrame, tick: int) -> DataFrame:
    """Events of one tick, by log id, from the lowest epoch that holds the tick."""
    _check_tick(tick)
    here = events.filter(F.col("tick") == tick)
    lowest = here.agg(F.min("epoch").alias("epoch"))
    return here.join(F.broadcast(lowest), "epoch", "left_semi").orderBy("log_id")


def events_for_ticks(events: DataFrame, ticks: DataFrame) -> DataFrame:
    """Batch form: for each wanted ``tick`` its epoch (0 if not found) and its events.

    A tick without events keeps one row with NULL event columns.
    """
    wanted = ticks.select("tick").distinct()
    exact, covered = _epochs_of(events, wanted)
    # An inner join, either side of which can be split at a tick with very many events.
    rows = exact.join(events, ["tick", "epoch"])
    empty = wanted.join(exact, "tick", "left_anti").join(covered, "tick", "left").select("tick", F.coalesce("epoch", F.lit(0)).alias("epoch"))
    return rows.unionByName(empty, allowMissingColumns=True)


def has_events(events: DataFrame, keys: DataFrame) -> DataFrame:
    """``keys`` (epoch, tick, log_id) with a flag ``present``; every key row is kept."""
    known = events.join(keys.select(*EVENT_KEY).distinct(), EVENT_KEY, "left_semi").select(*EVENT_KEY).distinct()
    return keys.join(known.withColumn("present", F.lit(True)), EVENT_KEY, "left").withColumn(
        "present", F.coalesce("present", F.lit(False))
    )


def has_event(events: DataFrame, epoch: int, tick: int, log_id: int) -> bool:
    match = (F.col("epoch") == epoch) & (F.col("tick") == tick) & (F.col("log_id") == log_id)
    return not events.filter(match).limit(1).isEmpty()


def count_events_per_tick(events: DataFrame) -> DataFrame:
    return events.groupBy("epoch", "tick").agg(F.count(F.lit(1)).alias("events"))


def epoch_ranges(events: DataFrame) -> DataFrame:
    return events.groupBy("epoch").agg(F.min("tick").alias("first_tick"), F.max("tick").alias("last_tick"))


def kept_epochs(events: DataFrame, keep: int) -> DataFrame:
    """The newest ``keep`` epochs, newest first (0 keeps all). At most one row per 16-bit epoch."""
    epochs = events.select("epoch").distinct().orderBy(F.desc("epoch"))
    return epochs.limit(keep) if keep else epochs


def retain_epochs(events: DataFrame, keep: int) -> DataFrame:
    """Events of the newest ``keep`` epochs."""
    if not keep:
        return events
    # The kept epochs are at most ``keep`` rows of 8 bytes.
    return events.join(F.broadcast(kept_epochs(events, keep)), "epoch", "left_semi")


def epoch_scope(stored: DataFrame, incoming: DataFrame, keep: int) -> DataFrame:
    """``incoming`` with ``in_scope``: false at or below the highest epoch that retention has dropped."""
    if not keep:
        return incoming.withColumn("in_scope", F.lit(True))
    dropped = stored.select("epoch").distinct().orderBy(F.desc("epoch")).offset(keep).limit(1)
    return incoming.withColumn("in_scope", F.coalesce(F.col("epoch") > dropped.scalar(), F.lit(True)))


def reject_out_of_scope(scoped: DataFrame) -> DataFrame:
    """Strict form of ``epoch_scope``: raise if a row is out of scope, else the rows without the flag."""
    bad = scoped.filter(~F.col("in_scope")).select("epoch").take(1)
    if bad:
        raise EpochOutOfScope(f"epoch {bad[0]['epoch']} is out of scope")
    return scoped.drop("in_scope")
