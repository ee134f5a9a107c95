"""Bridge: tick-stream messages -> topic rows, stored events and progress.

Every micro-batch runs in ``foreachBatch``: publish first, then store, then
progress; the checkpoint is committed last. All writes are keyed or replace
their own batch, so a batch that runs twice leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickflow.operators.bodies import parse_body
from tickflow.operators.enrich import enrich, ok_logs, tick_runs, with_marker
from tickflow.operators.events import EpochOutOfScope
from tickflow.operators.messages import build_event_message, rejection_rows, to_stored_event, to_topic_rows
from tickflow.operators.status import resume_from
from tickflow.operators.validate import BadRecords
from tickflow.schemas import DIVIDENDS_START
from tickflow.sinks.files import publish_ndjson
from tickflow.sinks.tables import PROGRESS_SCHEMA, events_table, newest_state, read_state, save_progress, write_batch
from tickflow.sources.tick_stream import arrival_numbers, explode_logs, parse_messages, with_place

#: Why a log of a dropped epoch is rejected.
OUT_OF_SCOPE = "epoch out of scope"

#: Takes topic rows and the batch id.
Publisher = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class BridgeTables:
    """Folders of one bridge."""

    root: str

    @property
    def topic(self) -> str:
        return f"{self.root}/topic"

    @property
    def events(self) -> str:
        return f"{self.root}/events"

    @property
    def progress(self) -> str:
        return f"{self.root}/progress"

    @property
    def errors(self) -> str:
        return f"{self.root}/errors"

    def publish(self, rows: DataFrame, batch: int) -> None:
        publish_ndjson(rows, f"{self.topic}/batch={batch}")


def carry_tick_state(previous: DataFrame) -> dict | None:
    """What the last tick of the batch before hands over: its next index and whether a section is open."""
    row = previous.select("last_tick", "next_index", "section_open").first()
    if row is None:
        return None
    return {"tick": row["last_tick"], "next_index": row["next_index"], "section_open": row["section_open"]}


def progress_row(enriched: DataFrame, previous: DataFrame) -> DataFrame:
    """Progress after a batch: the last log of the last run, or what was there if the batch had no log."""
    open_after = F.col("dividend") | F.coalesce(F.col("parsed.customMessage") == DIVIDENDS_START, F.lit(False))
    # Runs may be as many as messages; only rows of the last one are compared.
    last = enriched.filter(F.col("run") == enriched.agg(F.max("run").alias("run")).scalar())
    new = last.agg(
        F.max_by("epoch", "index_in_tick").alias("epoch"),
        F.max_by("log_id", "index_in_tick").alias("last_log_id"),
        F.max_by("tick", "index_in_tick").alias("last_tick"),
        (F.max("index_in_tick") + 1).alias("next_index"),
        F.max_by(open_after, "index_in_tick").alias("section_open"),
    ).filter(F.col("last_tick").isNotNull())
    columns = ["epoch", "last_log_id", "last_tick", "next_index", "section_open"]
    both = new.select(*columns, F.lit(1).alias("__age")).unionByName(previous.select(*columns, F.lit(0).alias("__age")))
    return both.orderBy(F.desc("__age")).limit(1).drop("__age")


def process_bridge_batch(
    messages: DataFrame,
    batch: int,
    tables: BridgeTables,
    method: str,
    publish: Publisher | None = None,
    start_tick: int | None = None,
    mode: str = "strict",
    keep_epochs: int = 0,
) -> None:
    """One micro-batch of message text.

    With ``keep_epochs`` only the newest epochs stay in the table of events; logs of an epoch at or below the highest that
    was dropped by an earlier batch are rejected as out of scope.

    A log that cannot be read, has a bad body or is out of scope fails the batch before anything is written (``strict``). In
    ``quarantine`` mode it goes to the error table, with its text and its place; a record of ``REJECTED_TYPE`` stands
    for it in the topic, so that its tick completes. So every log that is not marked as bad by
    the node is either published or an error. A message that cannot be read at all is an error as a whole.
    """
    spark = messages.sparkSession
    previous = read_state(spark, tables.progress, batch - 1, PROGRESS_SCHEMA)
    events = events_table(spark, tables.events)
    before = events.version(batch - 1)
    dropped = before.dropped if keep_epochs else -1
    # The messages are parsed once: for their numbers, their runs, their logs, and the strict check. So are the logs, which are
    # numbered in chunks, counted by chunk, and counted by blocks of chunks.
    parsed = parse_messages(with_place(messages), method).persist()
    parts = kept_partitions(parsed)
    numbered = tick_runs(with_numbers(arrival_numbers(parsed.filter("kind = 'ticks'"))), parts)
    # What is kept of a log is what later steps ask for: a column that is kept costs as much as one that is read.
    decoded = with_marker(ok_logs(explode_logs(numbered)).drop("ok", "message_epoch", "message_tick")).persist()
    logs = decoded
    if start_tick is not None:
        logs = logs.filter(F.col("tick") >= start_tick)
    rows = parse_body(enrich(logs, carry_tick_state(previous), parts))
    gone = F.when(F.col("epoch") <= dropped, F.lit(OUT_OF_SCOPE))
    rows = rows.withColumn("reason", F.coalesce("log_error", "parse_error", gone))
    rows = rows.withColumn("text", F.when(F.col("reason").isNotNull(), F.coalesce("rejected_text", "body")))
    rows = rows.drop("marker", "log_error", "parse_error", "rejected_text", "body").persist()
    try:
        bad, good = rows.filter("reason is not null"), rows.filter("reason is null")
        topic = to_topic_rows(build_event_message(good))
        if mode == "strict":
            if not parsed.filter("kind = 'malformed'").select("kind").isEmpty():
                raise BadRecords("malformed message")
            failed = bad.select("type", "reason").take(1)
            if failed and failed[0]["reason"] == OUT_OF_SCOPE:
                raise EpochOutOfScope(f"epochs up to {dropped} are out of scope")
            if failed:
                raise BadRecords(f"log of type {failed[0]['type']}: {failed[0]['reason']}")
        else:
            errors = bad.select("epoch", "tick", "index_in_tick", "log_id", "type", "reason", "text")
            broken = parsed.filter("kind = 'malformed'").select(F.lit("malformed message").alias("reason"), F.col("malformed_text").alias("text"))
            write_batch(errors.unionByName(broken, allowMissingColumns=True), tables.errors, batch)
            topic = topic.unionByName(rejection_rows(bad))
        (publish or tables.publish)(topic, batch)
        stored = to_stored_event(good, "msg_seq", "pos")
        events.append(stored, batch, "msg_seq", "pos", keep_epochs=keep_epochs, before=before)
        save_progress(progress_row(rows, previous), tables.progress, batch)
    finally:
        rows.unpersist()
        decoded.unpersist()
        parsed.unpersist()


def kept_partitions(scanned: DataFrame) -> int:
    """In how many partitions the logs of a batch are kept: three a core, or two for each split that was read, if that is more, and
    never more than a shuffle has. Frames that are kept are not coalesced, and each later shuffle writes partitions times shuffle
    partitions pieces: with as many partitions as shuffles have, these grow with the square of that number."""
    spark = scanned.sparkSession
    wanted = max(3 * spark.sparkContext.defaultParallelism, 2 * scanned.rdd.getNumPartitions())
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)


def with_numbers(messages: DataFrame) -> DataFrame:
    """Messages that came without a place (not from a file or topic) are numbered by ``monotonically_increasing_id``: in the
    order of the frame."""
    return messages if "msg_seq" in messages.columns else messages.withColumn("msg_seq", F.monotonically_increasing_id())


def run_bridge(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    method: str,
    interval: str | None = None,
    **options,
) -> StreamingQuery:
    """Start the bridge over a stream of message text (``value`` and the place it stands in) of the subscription ``method``.

    Without ``interval`` the job takes what is there and ends.
    """
    tables = BridgeTables(root)
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch: process_bridge_batch(df, batch, tables, method, **options)
    )
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def start_position(spark: SparkSession, tables: BridgeTables, initial_tick: int, override_tick: int | None = None) -> DataFrame:
    """``start_tick`` for a source that is asked for ticks: saved tick + 1, the initial tick, or the override."""
    saved = newest_state(spark, tables.progress, PROGRESS_SCHEMA)
    return resume_from(saved.withColumnRenamed("last_tick", "last_processed_tick"), initial_tick, override_tick)
