"""Tick counters, completeness and the highest complete tick."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.operators.events import latest_by_key

COUNTERS = ["processed", "skipped", "total"]


def is_complete() -> Column:
    """The size of the tick is known and that many records were seen."""
    return (F.col("total") > 0) & (F.col("processed") + F.col("skipped") >= F.col("total"))


def tick_counters(routed: DataFrame) -> DataFrame:
    """Counters per tick over routed records: processed, skipped, and total (0 if not known).

    The total is the index of the last log of the tick plus one. Ticks and totals are unsigned 64-bit numbers.
    """
    size = F.when(F.col("lastLogForTick"), (F.col("index").cast("decimal(20,0)") + 1).cast("decimal(20,0)"))
    return (
        routed.filter(F.col("status").isin("processed", "skipped"))
        .groupBy(F.col("tickNumber").cast("decimal(20,0)").alias("tick"))
        .agg(
            F.count_if(F.col("status") == "processed").alias("processed"),
            F.count_if(F.col("status") == "skipped").alias("skipped"),
            F.coalesce(F.max(size), F.lit(0)).alias("total"),
        )
    )


def merge_counters(state: DataFrame, deltas: DataFrame) -> DataFrame:
    """Stored counters plus a batch: counts add up, a known total replaces the old one."""
    both = state.select("tick", *COUNTERS, F.lit(0).alias("__age")).unionByName(
        deltas.select("tick", *COUNTERS, F.lit(1).alias("__age"))
    )
    return both.groupBy("tick").agg(
        F.sum("processed").alias("processed"),
        F.sum("skipped").alias("skipped"),
        F.coalesce(
            F.max(F.when((F.col("__age") == 1) & (F.col("total") > 0), F.col("total"))),
            F.max(F.when(F.col("__age") == 0, F.col("total"))),
            F.lit(0),
        ).alias("total"),
    )


def tick_status(routed: DataFrame) -> DataFrame:
    """Counters with ``complete``, as delivered: a redelivered record counts again."""
    return tick_counters(routed).withColumn("complete", is_complete())


def tick_status_exact(routed: DataFrame, keys: list[str], *arrival: str) -> DataFrame:
    """Counters over the last delivery of every key."""
    return tick_status(latest_by_key(routed, keys, *arrival))


def complete_ticks(status: DataFrame) -> DataFrame:
    return status.filter("complete")


def highest_tick(status: DataFrame) -> DataFrame:
    """The highest complete tick with a processed record, and its processed count (one row or none)."""
    eligible = status.filter(is_complete() & (F.col("processed") > 0))
    return (
        eligible.agg(F.max("tick").alias("tick"), F.max_by("processed", "tick").alias("processed"))
        .filter(F.col("tick").isNotNull())
    )


def prune_ticks(status: DataFrame, highest: int | None) -> DataFrame:
    """Counters without the ticks strictly below ``highest``."""
    return status if highest is None else status.filter(F.col("tick") >= highest)


def above(ticks: DataFrame, highest: int | None) -> DataFrame:
    """Only ticks above the stored highest one; late ticks no longer count."""
    return ticks if highest is None else ticks.filter(F.col("tick") > highest)


def indexed_height(routed: DataFrame) -> DataFrame:
    """Highest tick among processed records and its (lowest) epoch."""
    processed = routed.filter(F.col("status") == "processed")
    per_tick = processed.groupBy(F.col("tickNumber").cast("decimal(20,0)").alias("tick")).agg(
        F.min("epoch").alias("epoch")
    )
    return per_tick.agg(F.max("tick").alias("tick"), F.max_by("epoch", "tick").alias("epoch"))


def batch_totals(routed: DataFrame) -> DataFrame:
    """Records read and documents written."""
    return routed.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("status") == "processed").alias("documents")
    )
