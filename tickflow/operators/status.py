"""Status of the event store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.operators.events import EVENT_KEY, latest_by_key


def epoch_status(events: DataFrame, *arrival: str) -> DataFrame:
    """First tick, last tick and number of distinct events per epoch.

    ``arrival`` names the order of arrival if ``events`` may hold resent keys.
    """
    return epoch_status_delivered(latest_by_key(events, EVENT_KEY, *arrival) if arrival else events)


def epoch_status_delivered(events: DataFrame) -> DataFrame:
    """The same over all deliveries: a resent event counts again."""
    return events.groupBy("epoch").agg(
        F.min("tick").alias("first_tick"), F.max("tick").alias("last_tick"), F.count(F.lit(1)).alias("total_events")
    )


def available_epochs(events: DataFrame) -> DataFrame:
    return events.select("epoch").distinct().orderBy("epoch")


def epoch_tick_range(events: DataFrame, epoch: int) -> DataFrame:
    """First and last tick of one epoch; no row if the epoch is not there."""
    return (
        epoch_status_delivered(events.filter(F.col("epoch") == epoch)).select("epoch", "first_tick", "last_tick")
    )


def count_events_for_tick(events: DataFrame, epoch: int, tick: int) -> DataFrame:
    """Number of events of a tick in an epoch; 0 if there are none."""
    return events.filter((F.col("epoch") == epoch) & (F.col("tick") == tick)).agg(F.count(F.lit(1)).alias("events"))


def _per_epoch(events: DataFrame) -> DataFrame:
    """Tick range, size and last log id per epoch; ticks are combined first, then epochs."""
    per_tick = events.groupBy("epoch", "tick").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("log_id", "index_in_tick").alias("last_log_id")
    )
    return per_tick.groupBy("epoch").agg(
        F.min("tick").alias("first_tick"),
        F.max("tick").alias("last_tick"),
        F.sum("n").alias("total_events"),
        F.max_by("last_log_id", "tick").alias("last_log_id"),
    )


def _progress_columns() -> list:
    return [
        F.max("epoch").alias("current_epoch"),
        F.max_by("last_tick", "epoch").alias("last_processed_tick"),
        F.max_by("last_log_id", "epoch").alias("last_processed_log_id"),
    ]


def progress(events: DataFrame) -> DataFrame:
    """Current epoch, last tick and last log id: those of the last event in (epoch, tick, index) order."""
    return _per_epoch(events).agg(*_progress_columns()).filter(F.col("current_epoch").isNotNull())


def service_status(events: DataFrame) -> DataFrame:
    """One row: epochs ascending (each with one tick interval and its count) and the progress.

    The array has one entry per epoch, and epochs are 16-bit numbers.
    """
    interval = F.struct(F.col("first_tick").alias("firstTick"), F.col("last_tick").alias("lastTick"))
    info = F.struct("epoch", F.array(interval).alias("intervals"), F.col("total_events").alias("totalEvents"))
    return _per_epoch(events).agg(F.sort_array(F.collect_list(info)).alias("epochs"), *_progress_columns())


def resume_from(
    saved: DataFrame, initial_tick: int, override_tick: int | None = None
) -> DataFrame:
    """``start_tick``: the override, else the tick after the saved one, else the initial tick.

    ``saved`` is the one-row progress table, or empty.
    """
    last = F.max("last_processed_tick")
    start = F.lit(override_tick) if override_tick is not None else F.coalesce(last + 1, F.lit(initial_tick))
    return saved.agg(last.alias("__last"), start.cast("bigint").alias("start_tick")).select("start_tick")
