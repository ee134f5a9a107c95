"""Per-tick enrichment of log rows: index, last-in-message flag, dividend section.

Input rows have ``tick``, ``msg_seq`` (arrival order of messages), ``pos``
(place inside the message), ``ok`` and what the flag needs. All three columns
come from one window over (tick, chunk), so the rows are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tickflow.functions.tx_hash import dividend_marker
from tickflow.operators.prefix import carry_forward

#: Messages per chunk (as a power of two). A message is one row of JSON, so a chunk is bounded.
CHUNK_BITS = 6
#: Room for the place of a log inside its message when both are packed in one BIGINT.
_POS_BITS = 40
#: Messages per chunk where a row is one message (as a power of two).
_NARROW_CHUNK_BITS = 16


def ok_logs(logs: DataFrame) -> DataFrame:
    """Logs the node marked as good."""
    return logs.filter("ok")


def with_marker(logs: DataFrame) -> DataFrame:
    """Add ``marker``: 1 opens, 0 closes a dividend section. Only custom messages are looked into."""
    body = logs.schema["body"].dataType
    if isinstance(body, StringType):
        message = "get_json_object(body, '$.customMessage')"
    else:
        message = "try_variant_get(body, '$.customMessage', 'string')"
    marker = dividend_marker("type", message)
    if "log_error" in logs.columns:
        marker = f"case when log_error is null then {marker} end"
    return logs.withColumn("marker", F.expr(marker))


def tick_runs(messages: DataFrame, parts: int | None = None) -> DataFrame:
    """Add ``run`` to messages (``msg_seq``, one of its own for each, and ``result.tick``): how many changes of tick lie before.

    Indices and dividend sections belong to a run: a tick that comes back after another one starts anew. Messages are
    compared inside chunks of 2^16, as narrow rows; one row per chunk says what changes at its border. With ``parts`` the
    messages come back in so many partitions.
    """
    rows = messages.selectExpr("msg_seq", "coalesce(result.tick, 0) tick", f"shiftright(msg_seq, {_NARROW_CHUNK_BITS}) __chunk")
    inside = "over (partition by __chunk order by msg_seq)"
    changes = rows.selectExpr("*", f"coalesce(cast(tick <> lag(tick) {inside} as bigint), 0) __change")
    local = changes.selectExpr("msg_seq", "__chunk", f"sum(__change) {inside} __local")
    ends = changes.groupBy("__chunk").agg(F.expr("min_by(tick, msg_seq) first"), F.expr("max_by(tick, msg_seq) last"), F.expr("sum(__change) n"))
    ends = ends.selectExpr("__chunk", "n", "coalesce(cast(first <> lag(last) over (order by __chunk) as bigint), 0) border")
    begins = ends.selectExpr("__chunk", "sum(n + border) over (order by __chunk) - n __begin")
    runs = local.join(begins, "__chunk").selectExpr("msg_seq", "__begin + __local run")
    return (messages.repartition(parts, "msg_seq") if parts else messages).join(runs, "msg_seq")


def enrich(logs: DataFrame, resume: dict | None = None, parts: int | None = None) -> DataFrame:
    """Add ``index_in_tick``, ``last_log_for_tick`` and ``dividend`` to ok log rows.

    * ``index_in_tick``: zero-based place among the ok logs of the tick, in
      (msg_seq, pos) order, over all messages of the tick;
    * ``last_log_for_tick``: the last ok log of its message;
    * ``dividend``: between the start and the end marker of the tick; markers
      themselves are not inside, an open section ends with the tick.

    Rows with a ``run`` (see ``tick_runs``) are numbered by run instead of by tick; the first run is 0.
    Rows that have their ``marker`` already keep it.

    ``resume`` continues a tick cut by an earlier batch:
    ``{"tick": t, "next_index": n, "section_open": bool}``. With ``parts`` the rows come back in so many partitions.
    """
    key = "run" if "run" in logs.columns else "tick"
    columns = [f"`{c}`" for c in logs.columns]
    rows = (logs if "marker" in logs.columns else with_marker(logs)).selectExpr("*", f"shiftright(msg_seq, {CHUNK_BITS}) __chunk")
    local = f"partition by {key}, __chunk order by msg_seq, pos"
    numbered = (rows.repartition(parts, key, "__chunk") if parts else rows).selectExpr(
        "*",
        f"cast(row_number() over ({local}) - 1 as bigint) __index",
        f"lead(msg_seq) over ({local}) __next",
        f"last(marker, true) over ({local} rows between unbounded preceding and current row) __section",
    )

    # One row per chunk. The marker seen last is the greatest (message, place, marker) packed in a
    # BIGINT, which a hash aggregate combines on the map side.
    in_chunk = f"(msg_seq & {(1 << CHUNK_BITS) - 1}L)"
    packed = f"shiftleft({in_chunk}, {_POS_BITS + 1}) + shiftleft(pos, 1) + marker"
    chunks = (
        rows.groupBy(key, "__chunk")
        .agg(F.expr("count(1) n"), F.expr(f"max(case when marker is not null then {packed} end) packed"))
        .selectExpr(key, "__chunk", "n", "cast(packed & 1 as int) marker")
    )
    before = carry_forward(chunks, [key], "__chunk", sums=["n"], lasts=["marker"])
    # Most ticks fit in one chunk: only chunks that inherit something are joined back.
    inherited = before.filter("before_n > 0 or before_marker is not null")
    joined = numbered.join(inherited, [key, "__chunk"], "left")

    offset, section = "coalesce(before_n, 0)", "__section, before_marker"
    if resume:
        here = f"tick = {int(resume['tick'])}" + (" and run = 0" if key == "run" else "")
        offset += f" + case when {here} then {int(resume['next_index'])} else 0 end"
        section += f", case when {here} then {int(resume['section_open'])} end"
    return joined.selectExpr(
        *columns,
        f"__index + {offset} index_in_tick",
        "__next is null or __next <> msg_seq last_log_for_tick",
        f"marker is null and coalesce({section}, 0) = 1 dividend",
    )


def index_in_tick(logs: DataFrame, resume: dict | None = None) -> DataFrame:
    return enrich(logs, resume).drop("last_log_for_tick", "dividend")


def last_log_for_tick(logs: DataFrame) -> DataFrame:
    return enrich(logs).drop("index_in_tick", "dividend")


def dividend_flag(logs: DataFrame) -> DataFrame:
    return enrich(logs).drop("index_in_tick", "last_log_for_tick")


def resumed_index(logs: DataFrame, stored: DataFrame) -> DataFrame:
    """Indices of logs that arrive after a restart: every tick goes on at its stored count."""
    counts = stored.groupBy("epoch", "tick").agg(F.count(F.lit(1)).alias("__stored"))
    return (
        index_in_tick(logs)
        .join(counts, ["epoch", "tick"], "left")
        .withColumn("index_in_tick", F.col("index_in_tick") + F.coalesce("__stored", F.lit(0)))
        .drop("__stored")
    )


def epoch_transitions(logs: DataFrame) -> DataFrame:
    """Messages whose epoch differs from that of the message before: msg_seq, tick, epochs.

    Messages are reduced to one narrow row each, then compared inside chunks;
    only the last epoch of every chunk is carried over chunk borders.
    """
    messages = logs.select("msg_seq", "tick", "epoch").distinct()
    rows = messages.selectExpr("*", f"shiftright(msg_seq, {_NARROW_CHUNK_BITS}) __chunk")
    compared = rows.selectExpr("*", "lag(epoch) over (partition by __chunk order by msg_seq, tick) __previous")
    # (message, tick) packed in a BIGINT (ticks are 32-bit numbers), for a hash aggregate.
    place = f"shiftleft(msg_seq & {(1 << _NARROW_CHUNK_BITS) - 1}L, 32) + tick"
    tails = rows.groupBy("__chunk").agg(F.expr(f"max_by(epoch, {place}) epoch"))
    before = carry_forward(tails, [], "__chunk", sums=[], lasts=["epoch"])
    return (
        compared.join(before, "__chunk", "left")
        .selectExpr("msg_seq", "tick", "coalesce(__previous, before_epoch) old_epoch", "epoch new_epoch")
        .filter("old_epoch <> new_epoch")
    )


def tick_batches(logs: DataFrame) -> DataFrame:
    """One row per publish call: the logs of one tick in one epoch, described by their ends."""
    return logs.groupBy("epoch", "tick").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("index_in_tick").alias("first_index"),
        F.max("index_in_tick").alias("last_index"),
        F.min("log_id").alias("first_log_id"),
        F.max("log_id").alias("last_log_id"),
    )
