"""Index: topic records -> documents, tick counters and the highest complete tick."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickflow.operators import ticks
from tickflow.operators.documents import doc_id, route_records
from tickflow.operators.validate import error_policy
from tickflow.schemas import DEFAULT_SUPPORTED_TYPES, DOCUMENT_COLUMNS
from tickflow.session import configure
from tickflow.sinks.tables import COUNTER_SCHEMA, HEIGHT_SCHEMA, documents_table, newest_state, read_state, write_batch, write_state


@dataclass(frozen=True)
class IndexTables:
    """Folders of one index."""

    root: str

    @property
    def documents(self) -> str:
        return f"{self.root}/documents"

    @property
    def counters(self) -> str:
        return f"{self.root}/counters"

    @property
    def height(self) -> str:
        return f"{self.root}/height"

    @property
    def errors(self) -> str:
        return f"{self.root}/errors"


def _highest(status: DataFrame) -> int | None:
    """The one number the driver needs to know."""
    row = ticks.highest_tick(status).first()
    return None if row is None else row["tick"]


def update_tick_height(routed: DataFrame, tables: IndexTables, batch: int) -> None:
    """Add a batch to the counters of ticks above the highest complete one, then drop what lies below the new one."""
    spark = routed.sparkSession
    state = read_state(spark, tables.counters, batch - 1, COUNTER_SCHEMA).drop("batch")
    deltas = ticks.above(ticks.tick_counters(routed), _highest(state))
    merged = ticks.merge_counters(state, deltas).persist()
    try:
        write_state(ticks.prune_ticks(merged, _highest(merged)), tables.counters, batch)
    finally:
        merged.unpersist()


def process_index_batch(
    records: DataFrame,
    batch: int,
    tables: IndexTables,
    types: Sequence[int] = DEFAULT_SUPPORTED_TYPES,
    mode: str = "strict",
    tick_status: bool = True,
) -> None:
    """One micro-batch of topic records: documents first, counters second."""
    # A failed record keeps its text.
    routed = route_records(records.withColumn("text", F.col("value")), types)
    routed = routed.withColumn("text", F.when(F.col("status") == "failed", F.col("text"))).persist()
    spark = records.sparkSession
    try:
        error_policy(routed, mode)
        if mode == "quarantine":
            write_batch(routed.filter("status = 'failed'").select("epoch", "logId", "reason", "text"), tables.errors, batch)
        arrival = [c for c in ("offset", "index", "logDigest") if c in routed.columns]
        documents = routed.filter("status = 'processed'").select(
            doc_id(F.col("epoch"), F.col("logId")).alias("doc_id"), *dict.fromkeys([*DOCUMENT_COLUMNS, *arrival])
        )
        documents_table(spark, tables.documents).append(documents, batch, *arrival)
        if tick_status:
            update_tick_height(routed, tables, batch)
    finally:
        routed.unpersist()


def run_index(
    records: DataFrame, root: str, checkpoint: str, interval: str | None = None, **options
) -> StreamingQuery:
    """Start the index over a stream of topic records (``value``). Without ``interval`` it takes what is there and ends."""
    tables = IndexTables(root)
    writer = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch: process_index_batch(df, batch, tables, **options)
    )
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def raise_height(changed: DataFrame, batch: int, tables: IndexTables) -> None:
    """Of the ticks whose counters a batch changed, the highest complete one above the stored one becomes the new one."""
    spark = changed.sparkSession
    before = read_state(spark, tables.height, batch - 1, HEIGHT_SCHEMA).select("tick", "processed")
    new = ticks.highest_tick(ticks.above(changed, _highest_stored(before)))
    # One row or none on either side; a new one is the higher one.
    both = new.unionByName(before).orderBy(F.desc("tick")).limit(1)
    write_state(both.coalesce(1), tables.height, batch)


def _highest_stored(state: DataFrame) -> int | None:
    row = state.first()
    return None if row is None else row["tick"]


def run_tick_height(
    records: DataFrame, root: str, checkpoint: str, types: Sequence[int] = DEFAULT_SUPPORTED_TYPES, interval: str | None = None
) -> StreamingQuery:
    """Start the tick counters as streaming state: counters per tick in update mode, kept and checkpointed by the state
    store, so that a batch reads and writes only the ticks it meets. A batch looks at those for the highest complete tick.

    Ticks at or below the highest one change nothing any more. The store keeps a row of four numbers for every tick.
    """
    tables = IndexTables(root)
    configure(records.sparkSession)
    counters = ticks.tick_counters(route_records(records, types))
    writer = counters.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch: raise_height(df, batch, tables)
    )
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def read_height(spark: SparkSession, tables: IndexTables) -> DataFrame:
    """The highest complete tick of ``run_tick_height`` and its processed count (one row or none)."""
    return newest_state(spark, tables.height, HEIGHT_SCHEMA).select("tick", "processed")


def read_highest_tick(spark: SparkSession, tables: IndexTables) -> DataFrame:
    """The stored highest complete tick and its processed count (one row or none)."""
    return ticks.highest_tick(newest_state(spark, tables.counters, COUNTER_SCHEMA))
