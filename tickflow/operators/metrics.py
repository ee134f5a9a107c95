"""Counts the services report, as queries. All of them combine on the map side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickflow.functions.tx_hash import type_name
from tickflow.operators.prefix import carry_forward


def metrics_by_type(parsed: DataFrame) -> DataFrame:
    """Per type: received (ok), processed (ok and parsed) and skipped (not ok) logs."""
    return (
        parsed.groupBy("type")
        .agg(
            F.count_if("ok").alias("received"),
            F.count_if(F.col("ok") & F.col("parse_error").isNull()).alias("processed"),
            F.count_if(~F.col("ok")).alias("skipped_not_ok"),
        )
        .withColumn("type_name", F.expr(type_name("type")))
    )


def bridge_failures(parsed: DataFrame) -> DataFrame:
    """Ok logs that failed, with ``failure_reason``.

    A custom message without a body has no dividend flag; it is counted, but kept.
    """
    reason = F.when(F.col("parse_error").isNotNull(), F.lit("parse_error")).when(
        (F.col("type") == 255) & F.col("parsed").isNull(), F.lit("dividend_calculation_error")
    )
    return parsed.filter("ok").withColumn("failure_reason", reason).filter("failure_reason is not null")


def failures_by_reason(failures: DataFrame, code: str = "type", reason: str = "failure_reason") -> DataFrame:
    return (
        failures.groupBy(F.col(code).alias("type"), F.col(reason).alias("failure_reason"))
        .agg(F.count(F.lit(1)).alias("failed"))
        .withColumn("type_name", F.expr(type_name("type")))
    )


def published_by_topic(topic_rows: DataFrame, topic: str) -> DataFrame:
    return (
        topic_rows.groupBy("type")
        .agg(F.count(F.lit(1)).alias("published"))
        .select("type", F.expr(type_name("type")).alias("type_name"), F.lit(topic).alias("topic"), "published")
    )


def state_gauges(enriched: DataFrame) -> DataFrame:
    """Epoch, tick and log id of the last log, and the number of logs in its tick."""
    per_tick = enriched.groupBy("epoch", "tick").agg(
        F.max_by("log_id", "index_in_tick").alias("last_log_id"), F.count(F.lit(1)).alias("events_in_tick")
    )
    order = F.struct("epoch", "tick")
    return per_tick.agg(
        F.max("epoch").alias("current_epoch"),
        F.max_by("tick", order).alias("last_tick"),
        F.max_by("last_log_id", order).alias("last_log_id"),
        F.max_by("events_in_tick", order).alias("events_in_tick"),
    )


def consumer_gauges(routed: DataFrame) -> DataFrame:
    """Processed records, and the highest indexed tick with its (lowest) epoch."""
    per_tick = (
        routed.filter(F.col("status") == "processed")
        .groupBy(F.col("tickNumber").cast("decimal(20,0)").alias("tick"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("epoch").alias("epoch"))
    )
    return per_tick.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("processed"),
        F.max("tick").alias("tick"),
        F.max_by("epoch", "tick").alias("epoch"),
    )


def rpc_errors(messages: DataFrame) -> DataFrame:
    """Error responses by code, labelled ``jsonrpc_<code>``."""
    return (
        messages.filter("kind = 'error'")
        .groupBy(F.concat(F.lit("jsonrpc_"), F.col("error.code").cast("string")).alias("error_code"))
        .agg(F.count(F.lit(1)).alias("errors"))
    )


def replay_totals(messages: DataFrame) -> DataFrame:
    """Events and ticks of a replay."""
    per_tick = messages.groupBy(F.col("tickNumber").alias("tick")).agg(F.count(F.lit(1)).alias("n"))
    return per_tick.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("events"), F.count(F.lit(1)).alias("ticks"))


def replay_progress(messages: DataFrame, every: int = 100) -> DataFrame:
    """Running totals after every ``every``-th tick: ticks, events and the tick reached."""
    per_tick = (
        messages.groupBy(F.col("tickNumber").cast("decimal(20,0)").alias("tick"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("__chunk", F.shiftright("tick", 12))
    )
    local = Window.partitionBy("__chunk").orderBy("tick").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = per_tick.select(
        "tick",
        "__chunk",
        F.count(F.lit(1)).over(local).alias("__ticks"),
        F.sum("n").over(local).alias("__events"),
    )
    chunks = per_tick.groupBy("__chunk").agg(F.count(F.lit(1)).alias("ticks"), F.sum("n").alias("events"))
    before = carry_forward(chunks, [], "__chunk", sums=["ticks", "events"], lasts=[]).withColumnRenamed("__chunk", "__c")
    return (
        running.join(before, F.col("__chunk") == F.col("__c"))
        .select(
            (F.col("__ticks") + F.col("before_ticks")).alias("ticks"),
            (F.col("__events") + F.col("before_events")).alias("events"),
            "tick",
        )
        .filter(F.col("ticks") % every == 0)
    )


def metric_balance(parsed: DataFrame) -> DataFrame:
    """One row: received = processed + deduplicated + failed + pending. Nothing is deduplicated or pending."""
    totals = parsed.filter("ok").agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("parse_error").isNull()).alias("processed"),
        F.count_if(F.col("parse_error").isNotNull()).alias("failed"),
    )
    return totals.select(
        "received",
        "processed",
        F.lit(0).cast("bigint").alias("deduplicated"),
        "failed",
        F.lit(0).cast("bigint").alias("pending"),
        (F.col("received") == F.col("processed") + F.col("failed")).alias("balanced"),
    )
