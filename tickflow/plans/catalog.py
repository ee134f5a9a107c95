"""Every registered query with the SQL that proves it.

A query takes (spark, sf_dir) and reads whole tables. ``portable`` casts what
DuckDB has no equal for (unsigned decimals, binaries, arrays) to plain types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.identity import is_identity
from tickflow.functions.tx_hash import tx_category, type_name
from tickflow.operators import documents, enrich, events, messages, metrics, status, ticks, validate
from tickflow.operators.bodies import parse_body, rename_body, source_body_json
from tickflow.plans import feeds
from tickflow.schemas import DOCUMENT_COLUMNS
from tickflow.session import configure
from tickflow.sources.tick_stream import explode_logs, parse_messages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Hour 100 of the feed, and a range around it.
_TICK = 473_352 + 100
_TOPIC = "log-events"


def portable(df: DataFrame) -> DataFrame:
    columns = []
    for name, kind in df.dtypes:
        column = f"`{name}`"
        if kind.startswith("decimal") or kind in ("smallint", "int"):
            column = f"cast({column} as bigint)"
        elif kind == "binary":
            column = f"hex({column})"
        elif kind.startswith("array"):
            column = f"array_join(cast({column} as array<string>), ',')"
        columns.append(f"{column} `{name}`")
    return df.selectExpr(*columns)


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its (function) name, with its DuckDB SQL."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(build(configure(spark), sf_dir))

        QUERIES[name or build.__name__] = run
        if sql is not None:
            ORACLES[name or build.__name__] = sql
        return run

    return register


def with_ctes(ctes: str, select: str) -> str:
    return f"with {ctes}\n{select}"


_LOG_COLUMNS = "msg_seq, pos, ok, epoch, tick, type, log_id, log_digest, body_size, timestamp, tx_hash, body"

# ------------------------------------------------------------ raw logs and enrichment


@query(with_ctes(feeds.SQL_FEED_E, f"select {_LOG_COLUMNS} from logs where ok"))
def ok_logs(spark, sf_dir):
    return enrich.ok_logs(feeds.feed_e(spark, sf_dir))


@query(
    with_ctes(
        feeds.SQL_FEED_E,
        """select msg_seq, row_number() over (partition by msg_seq, tick order by pos) - 1 as pos, ok, epoch, tick, type, log_id,
             log_digest, body_size, coalesce(timestamp, 0) as timestamp, tx_hash,
             json_extract_string(body, '$.amount') as amount, json_extract_string(body, '$.from') as source
           from logs""",
    )
)
def explode_messages(spark, sf_dir):
    """Message text -> parsed notifications -> one row per log."""
    rows = explode_logs(parse_messages(feeds.feed_messages(spark, sf_dir), feeds.METHOD))
    return rows.withColumns(
        {
            "amount": F.get_json_object("body", "$.amount"),
            "source": F.get_json_object("body", "$.from"),
        }
    ).drop("body", "message_epoch", "message_tick", "log_error", "rejected_text")


@query(
    with_ctes(
        feeds.SQL_FEED_E,
        "select 'ticks' as kind, count(distinct (msg_seq, tick)) as messages, count(*) as logs from logs",
    )
)
def message_kinds(spark, sf_dir):
    parsed = parse_messages(feeds.feed_messages(spark, sf_dir), feeds.METHOD)
    return parsed.groupBy("kind").agg(
        F.count(F.lit(1)).alias("messages"), F.sum(F.size("result.logs")).alias("logs")
    )


@query(
    with_ctes(
        feeds.SQL_FEED_E,
        f"select log_id, type, {feeds.SQL_SOURCE_BODY} as body, cast(null as varchar) as parse_error from logs",
    )
)
def parsed_bodies(spark, sf_dir):
    parsed = feeds.parsed_e(spark, sf_dir)
    return parsed.select("log_id", "type", F.expr(source_body_json()).alias("body"), "parse_error")


@query(with_ctes(feeds.SQL_FEED_E, f"select log_id, type, {feeds.SQL_TOPIC_BODY} as body from logs"))
def renamed_bodies(spark, sf_dir):
    return feeds.parsed_e(spark, sf_dir).select("log_id", "type", F.expr(rename_body()).alias("body"))


@query(with_ctes(feeds.SQL_ENRICHED_E, "select epoch, tick, log_id, index_in_tick from enr"))
def index_in_tick(spark, sf_dir):
    logs = enrich.ok_logs(feeds.feed_e(spark, sf_dir))
    return enrich.index_in_tick(logs).select("epoch", "tick", "log_id", "index_in_tick")


@query(with_ctes(feeds.SQL_ENRICHED_E, "select epoch, tick, log_id, last_log_for_tick from enr"))
def last_log_flag(spark, sf_dir):
    logs = enrich.ok_logs(feeds.feed_e(spark, sf_dir))
    return enrich.last_log_for_tick(logs).select("epoch", "tick", "log_id", "last_log_for_tick")


@query(with_ctes(feeds.SQL_ENRICHED_E, "select epoch, tick, log_id, dividend from enr"))
def dividend_flag(spark, sf_dir):
    logs = enrich.ok_logs(feeds.feed_e(spark, sf_dir))
    return enrich.dividend_flag(logs).select("epoch", "tick", "log_id", "dividend")


@query(
    with_ctes(
        feeds.SQL_ENRICHED_E,
        "select epoch, tick, log_id, index_in_tick + count(*) over (partition by epoch, tick) as index_in_tick from enr",
    )
)
def resumed_index(spark, sf_dir):
    """The whole feed sent again on top of itself: indices go on where the stored ones end."""
    again = enrich.ok_logs(feeds.feed_e(spark, sf_dir))
    return enrich.resumed_index(again, feeds.stored_e(spark, sf_dir)).select("epoch", "tick", "log_id", "index_in_tick")


@query(
    with_ctes(
        feeds.SQL_FEED_E,
        """, m as (select distinct msg_seq, tick, epoch from logs),
           p as (select *, lag(epoch) over (order by msg_seq, tick) old_epoch from m)
           select msg_seq, tick, old_epoch, epoch as new_epoch from p where old_epoch <> epoch""",
    )
)
def epoch_transitions(spark, sf_dir):
    return enrich.epoch_transitions(feeds.feed_e(spark, sf_dir))


@query(
    with_ctes(
        feeds.SQL_ENRICHED_E,
        """select epoch, tick, count(*) as events, min(index_in_tick) as first_index, max(index_in_tick) as last_index,
             min(log_id) as first_log_id, max(log_id) as last_log_id from enr group by epoch, tick""",
    )
)
def tick_batches(spark, sf_dir):
    return enrich.tick_batches(enrich.index_in_tick(enrich.ok_logs(feeds.feed_e(spark, sf_dir))))


# ------------------------------------------------------------ messages and stored events


@query(with_ctes(feeds.SQL_MESSAGES_E, "select * from messages"))
def event_messages(spark, sf_dir):
    return messages.build_event_message(feeds.enriched_e(spark, sf_dir))


@query(
    with_ctes(
        feeds.SQL_MESSAGES_E,
        f'select cast(tickNumber as varchar) as "key", {feeds.SQL_TOPIC_VALUE} as "value" from messages',
    )
)
def topic_rows(spark, sf_dir):
    return feeds.topic_e(spark, sf_dir).select("key", "value")


@query(with_ctes(feeds.SQL_STORED_E, "select * from stored"))
def stored_events(spark, sf_dir):
    return feeds.stored_e(spark, sf_dir)


_LATEST_L = (
    feeds.SQL_FEED_L
    + """,
ranked as (
  select *, row_number() over (partition by epoch, tick, log_id
    order by l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc) r
  from deliveries),
latest as (select * exclude (r) from ranked where r = 1)"""
)
_L_COLUMNS = "epoch, tick, log_id, ok, type, amount, source, destination"


def _latest_l(spark, sf_dir):
    return events.latest_by_key(feeds.feed_l(spark, sf_dir), events.EVENT_KEY, *feeds.FEED_L_ARRIVAL)


@query(with_ctes(_LATEST_L, f"select {_L_COLUMNS} from latest"))
def latest_by_key(spark, sf_dir):
    return _latest_l(spark, sf_dir).select(*_L_COLUMNS.split(", "))


@query(
    with_ctes(
        feeds.SQL_FEED_L,
        """, once as (
             select epoch, tick, log_id, max(case when ok then amount end) good, max(case when not ok then amount end) bad,
               bool_or(ok) has_good from deliveries group by epoch, tick, log_id)
           select epoch, tick, log_id, case when has_good then good else bad end as amount, has_good as ok from once""",
    )
)
def upsert_events(spark, sf_dir):
    """Failed deliveries first, good ones put over them by key."""
    best = feeds.feed_l(spark, sf_dir).groupBy(*events.EVENT_KEY, "ok").agg(F.max("amount").alias("amount"))
    return events.upsert_events(best.filter("not ok"), best.filter("ok"))


@query(
    with_ctes(
        feeds.SQL_STORED_E,
        f"""select s.index_in_tick as "index", s.event_type as type, s.tick as tickNumber, s.epoch, s.log_digest as logDigest,
              s.log_id as logId, 0 as bodySize, s.timestamp as "timestamp", s.tx_hash as transactionHash,
              m.body, false as dividend, s.last_log_for_tick as lastLogForTick
            from stored s join (select log_id, {feeds.SQL_TOPIC_BODY} body from logs) m using (log_id)""",
    ).replace("0 as bodySize", "cast(0 as bigint) as bodySize")
)
def replay_messages(spark, sf_dir):
    return messages.replay_messages(feeds.stored_e(spark, sf_dir)).drop("rename_error")


@query(
    with_ctes(
        feeds.SQL_STORED_E,
        "select count(*) as events, count(distinct tick) as ticks from stored where epoch = 2",
    )
)
def replay_totals(spark, sf_dir):
    one = events.events_in_range(feeds.stored_e(spark, sf_dir), 2)
    return metrics.replay_totals(messages.replay_messages(one))


@query(
    with_ctes(
        feeds.SQL_STORED_E,
        """, per_tick as (select tick, count(*) n from stored group by tick),
           running as (select tick, row_number() over (order by tick) ticks, cast(sum(n) over (order by tick) as bigint) events
             from per_tick)
           select ticks, events, tick from running where ticks % 100 = 0""",
    )
)
def replay_progress(spark, sf_dir):
    return metrics.replay_progress(messages.replay_messages(feeds.stored_e(spark, sf_dir)))


# ------------------------------------------------------------ validation and documents

_RAW_EVENT = {
    "epoch": "epoch",
    "tickNumber": "tick",
    "logId": "log_id",
    "timestamp": "timestamp",
    "logDigest": "log_digest",
    "index": "pos",
    "type": "type",
}


def _raw_events(spark, sf_dir):
    """Feed E as nullable event columns."""
    return feeds.feed_e(spark, sf_dir).selectExpr(*[f"{source} as `{name}`" for name, source in _RAW_EVENT.items()])


@query(with_ctes(feeds.SQL_FEED_E, "select log_id as logId, case when timestamp is null then 'timestamp' end as missing from logs"))
def required_errors(spark, sf_dir):
    return validate.validate_required(_raw_events(spark, sf_dir)).select("logId", "missing")


@query(with_ctes(feeds.SQL_FEED_E, "select log_id as logId, case when log_digest = '' then 'logDigest' end as zero from logs"))
def zero_errors(spark, sf_dir):
    return validate.validate_nonzero(_raw_events(spark, sf_dir)).select("logId", "zero")


@query(
    with_ctes(
        feeds.SQL_FEED_E,
        """select log_id, timestamp * 1000 as millis, case when timestamp * log_id <= 10000000000 then timestamp * log_id * 1000 end as guarded
           from logs""",
    )
)
def millis_guard(spark, sf_dir):
    """Seconds to milliseconds; times multiplied by the log id mostly fail the guard."""
    return feeds.feed_e(spark, sf_dir).selectExpr(
        "log_id", f"{validate.to_millis('timestamp')} as millis", f"{validate.to_millis('(timestamp * log_id)')} as guarded"
    )


@query(
    with_ctes(
        feeds.SQL_FEED_E,
        """select log_id, tx_hash, case when tx_hash like 'SC_END_TICK_TX_%' then 4 when tx_hash like 'SC_BEGIN_TICK_TX_%' then 3
             when tx_hash like 'SC_NOTIFICATION_TX%' then 6 end as category,
             length(tx_hash) = 60 as is_digest, tx_hash <> 'SC_BAD_TX_1' as known from logs""",
    ).replace("end as category", "end::bigint as category"),
    name="tx_category",
)
def tx_category_by_hash(spark, sf_dir):
    rows = feeds.feed_e(spark, sf_dir).select(
        "log_id", "tx_hash", F.expr(tx_category("tx_hash")).alias("category"), is_identity(F.col("tx_hash")).alias("is_digest")
    )
    return rows.withColumn("known", (F.col("tx_hash") == "") | F.col("is_digest") | F.col("category").isNotNull())


@query(
    with_ctes(
        feeds.SQL_FEED_E,
        "select tx_hash, length(tx_hash) = 60 as valid, count(*) as logs from logs where ok group by tx_hash",
    )
)
def identity_verdicts(spark, sf_dir):
    """Every distinct hash checked once, and how many logs carry it."""
    return documents.identity_verdicts(enrich.ok_logs(feeds.feed_e(spark, sf_dir)))


_ROUTED = ", ".join(f'"{c}"' for c in DOCUMENT_COLUMNS)


@query(
    with_ctes(feeds.SQL_ROUTED_E, """select logId, categories, status from routed where categories is not null""")
)
def categories(spark, sf_dir):
    routed = feeds.routed_e(spark, sf_dir)
    return routed.filter("categories is not null").select("logId", "categories", "status")


@query(with_ctes(feeds.SQL_ROUTED_E, f"select {_ROUTED} from routed where status = 'processed'"), name="documents")
def document_rows(spark, sf_dir):
    return feeds.routed_e(spark, sf_dir).filter("status = 'processed'").select(*DOCUMENT_COLUMNS)


@query(with_ctes(feeds.SQL_ROUTED_E, "select concat(epoch, '-', logId) as doc_id, status from routed"))
def document_ids(spark, sf_dir):
    routed = feeds.routed_e(spark, sf_dir)
    return routed.select(documents.doc_id(F.col("epoch"), F.col("logId")).alias("doc_id"), "status")


_TEXTS = {"transactionHash", "logDigest", "source", "destination", "assetName", "assetIssuer", "owner", "possessor", "queryingEntity"}


def _json_member(name: str) -> str:
    """One JSON member; the whole text is NULL, and so left out, if the value is."""
    value = f'"{name}"'
    if name == "categories":
        value = f"'[' || {value} || ']'"
    elif name in ("unitOfMeasurement", "rawPayload"):
        value = f"'\"' || to_base64(unhex({value})) || '\"'"
    elif name in _TEXTS:
        value = f"'\"' || nullif({value}, '') || '\"'"
    return f"'\"{name}\":' || {value}"


_DOC_JSON = "'{' || concat_ws(',', " + ", ".join(_json_member(c) for c in DOCUMENT_COLUMNS) + ") || '}'"


@query(with_ctes(feeds.SQL_ROUTED_E, f"select logId, {_DOC_JSON} as document from routed where status = 'processed'"))
def document_json(spark, sf_dir):
    routed = feeds.routed_e(spark, sf_dir).filter("status = 'processed'")
    return routed.select("logId", documents.document_json(routed).alias("document"))


@query(
    with_ctes(
        feeds.SQL_ROUTED_E,
        f"""select '{{"index":{{"_id":"' || epoch || '-' || logId || '","_index":"log-docs"}}}}' || chr(10) || {_DOC_JSON} as value
            from routed where status = 'processed'""",
    )
)
def bulk_ndjson(spark, sf_dir):
    routed = feeds.routed_e(spark, sf_dir).filter("status = 'processed'")
    return documents.bulk_ndjson(routed, "log-docs")


@query(with_ctes(feeds.SQL_FEED_E, "select type, count(*) as logs from logs where type <> 7 group by type"))
def supported_filter(spark, sf_dir):
    rows = documents.supported(feeds.feed_e(spark, sf_dir))
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("logs"))


@query(
    with_ctes(
        feeds.SQL_ROUTED_E,
        """select logType, logId, amount from routed
           where (reason is null or reason in ('unsupported type', 'zero amount')) and not (logType in (0, 8) and amount = 0)""",
    )
)
def zero_amount_filter(spark, sf_dir):
    routed = feeds.routed_e(spark, sf_dir).filter(
        "reason is null or reason in ('unsupported type', 'zero amount')"
    )
    return documents.nonzero_amount(routed).select("logType", "logId", "amount")


@query(with_ctes(feeds.SQL_ROUTED_E, "select status, reason, count(*) as records from routed group by status, reason"))
def routed_counts(spark, sf_dir):
    return feeds.routed_e(spark, sf_dir).groupBy("status", "reason").agg(F.count(F.lit(1)).alias("records"))


# ------------------------------------------------------------ tick height

_STATUS_E = (
    feeds.SQL_ROUTED_E
    + """,
counters as (
  select tickNumber as tick, count(*) filter (status = 'processed') as processed, count(*) filter (status = 'skipped') as skipped,
    coalesce(max(case when lastLogForTick then "index" + 1 end), 0) as total
  from routed where status in ('processed', 'skipped') group by tickNumber),
tick_status as (select *, total > 0 and processed + skipped >= total as complete from counters)"""
)


@query(with_ctes(_STATUS_E, "select * from tick_status"))
def tick_status(spark, sf_dir):
    return ticks.tick_status(feeds.routed_e(spark, sf_dir))


def _delivered_l(spark, sf_dir):
    """Feed L as routed records: not ok = skipped; its place in the tick is not known, so sizes come from the latest rows."""
    return feeds.feed_l(spark, sf_dir).selectExpr(
        "*",
        "tick as tickNumber",
        "case when ok then 'processed' else 'skipped' end as status",
        "log_id % 8 as `index`",
        "log_id % 8 >= 6 as lastLogForTick",
    )


@query(
    with_ctes(
        _LATEST_L,
        """, counters as (
             select tick, count(*) filter (ok) as processed, count(*) filter (not ok) as skipped,
               coalesce(max(case when log_id % 8 >= 6 then log_id % 8 + 1 end), 0) as total from latest group by tick)
           select *, total > 0 and processed + skipped >= total as complete from counters""",
    )
)
def tick_status_exact(spark, sf_dir):
    return ticks.tick_status_exact(_delivered_l(spark, sf_dir), events.EVENT_KEY, *feeds.FEED_L_ARRIVAL)


@query(with_ctes(_STATUS_E, "select * from tick_status where complete"))
def complete_ticks(spark, sf_dir):
    return ticks.complete_ticks(ticks.tick_status(feeds.routed_e(spark, sf_dir)))


@query(
    with_ctes(_STATUS_E, "select tick, processed from tick_status where complete and processed > 0 order by tick desc limit 1")
)
def highest_tick(spark, sf_dir):
    return ticks.highest_tick(ticks.tick_counters(feeds.routed_e(spark, sf_dir)))


@query(
    with_ctes(
        _STATUS_E,
        """, h as (select max(tick) as tick from tick_status where complete and processed > 0)
           select s.* from tick_status s, h where s.tick >= h.tick""",
    )
)
def prune_ticks(spark, sf_dir):
    state = ticks.tick_status(feeds.routed_e(spark, sf_dir))
    return state.filter(F.col("tick") >= ticks.highest_tick(state).select("tick").scalar())


@query(
    with_ctes(
        feeds.SQL_ROUTED_E,
        "select max(tickNumber) as tick, arg_max(epoch, tickNumber) as epoch from routed where status = 'processed'",
    )
)
def indexed_height(spark, sf_dir):
    return ticks.indexed_height(feeds.routed_e(spark, sf_dir))


@query(
    with_ctes(
        feeds.SQL_ROUTED_E,
        "select count(*) as records, count(*) filter (status = 'processed') as documents from routed",
    )
)
def batch_totals(spark, sf_dir):
    return ticks.batch_totals(feeds.routed_e(spark, sf_dir))


# ------------------------------------------------------------ lookups


@query(with_ctes(feeds.SQL_STORED_E, f"select * from stored where tick = {_TICK}"))
def events_for_tick(spark, sf_dir):
    return events.events_for_tick(feeds.stored_e(spark, sf_dir), _TICK)


@query(
    with_ctes(
        feeds.SQL_STORED_E,
        """, wanted as (select distinct tick from stored union select distinct tick + 100000 from stored)
           select w.tick, coalesce(s.epoch, 0) as epoch, s.log_id, s.event_type, s.index_in_tick
           from wanted w left join stored s using (tick)""",
    )
)
def events_for_ticks(spark, sf_dir):
    """All ticks of the feed, and as many that do not exist (epoch 0, no event)."""
    stored = feeds.stored_e(spark, sf_dir)
    known = stored.select("tick").distinct()
    wanted = known.unionByName(known.select((F.col("tick") + 100_000).alias("tick")))
    return events.events_for_ticks(stored, wanted).select("tick", "epoch", "log_id", "event_type", "index_in_tick")


@query(
    with_ctes(feeds.SQL_STORED_E, f"select * from stored where epoch = 1 and tick between {_TICK - 20} and {_TICK + 20}")
)
def events_in_range(spark, sf_dir):
    return events.events_in_range(feeds.stored_e(spark, sf_dir), 1, _TICK - 20, _TICK + 20)


@query(with_ctes(feeds.SQL_STORED_E, "select * from stored where epoch = 3"))
def scan_events(spark, sf_dir):
    return events.scan_events(feeds.stored_e(spark, sf_dir), 3)


@query(
    with_ctes(
        feeds.SQL_FEED_E,
        """select l.epoch, l.tick, l.log_id, s.log_id is not null as present
           from logs l left join (select epoch, tick, log_id from logs where ok) s using (epoch, tick, log_id)""",
    )
)
def has_events(spark, sf_dir):
    """Every key of the raw feed, looked up among the stored (ok) events."""
    logs = feeds.feed_e(spark, sf_dir)
    return events.has_events(enrich.ok_logs(logs), logs.select(*events.EVENT_KEY))


@query(
    with_ctes(
        feeds.SQL_FEED_L,
        """, w as (select distinct tick from deliveries union select distinct tick + 400 from deliveries),
           x as (select tick, min(epoch) epoch from deliveries group by tick),
           r as (select epoch, min(tick) a, max(tick) b from deliveries group by epoch)
           select w.tick, coalesce(x.epoch, (select min(r.epoch) from r where w.tick between r.a and r.b)) as epoch
           from w left join x using (tick)
           where coalesce(x.epoch, (select min(r.epoch) from r where w.tick between r.a and r.b)) is not null""",
    )
)
def tick_to_epoch(spark, sf_dir):
    stored = feeds.feed_l(spark, sf_dir)
    days = stored.select("tick").distinct()
    return events.tick_to_epoch(stored, days.unionByName(days.select((F.col("tick") + 400).alias("tick"))))


@query(with_ctes(_LATEST_L, f"select {_L_COLUMNS} from latest where epoch in (select distinct epoch from latest order by epoch desc limit 3)"))
def retain_epochs(spark, sf_dir):
    return events.retain_epochs(_latest_l(spark, sf_dir), 3).select(*_L_COLUMNS.split(", "))


@query(
    with_ctes(
        feeds.SQL_FEED_L,
        """, dropped as (select distinct epoch from deliveries order by epoch desc offset 3)
           select epoch, count(*) as events, epoch > (select max(epoch) from dropped) as in_scope from deliveries group by epoch""",
    )
)
def epoch_scope(spark, sf_dir):
    feed = feeds.feed_l(spark, sf_dir)
    return events.epoch_scope(feed, feed, 3).groupBy("epoch", "in_scope").agg(F.count(F.lit(1)).alias("events"))


@query(with_ctes(feeds.SQL_STORED_E, "select epoch, tick, count(*) as events from stored group by epoch, tick"))
def count_events_per_tick(spark, sf_dir):
    return events.count_events_per_tick(feeds.stored_e(spark, sf_dir))


# ------------------------------------------------------------ status

_STATUS = "select epoch, min(tick) as first_tick, max(tick) as last_tick, count(*) as total_events from {} group by epoch"


@query(with_ctes(_LATEST_L, _STATUS.format("latest")))
def epoch_status(spark, sf_dir):
    return status.epoch_status(feeds.feed_l(spark, sf_dir), *feeds.FEED_L_ARRIVAL)


@query(with_ctes(feeds.SQL_FEED_L, _STATUS.format("deliveries")))
def epoch_status_delivered(spark, sf_dir):
    return status.epoch_status_delivered(feeds.feed_l(spark, sf_dir))


@query(
    with_ctes(
        feeds.SQL_STORED_E,
        """, per_epoch as (select epoch, min(tick) a, max(tick) b, count(*) n from stored group by epoch)
           select (select '[' || string_agg('{"epoch":' || epoch || ',"intervals":[{"firstTick":' || a || ',"lastTick":' || b
               || '}],"totalEvents":' || n || '}', ',' order by epoch) || ']' from per_epoch) as epochs,
             max(epoch) as current_epoch, max(tick) as last_processed_tick,
             arg_max(log_id, tick * 1000000 + index_in_tick) as last_processed_log_id from stored""",
    )
)
def service_status(spark, sf_dir):
    return status.service_status(feeds.stored_e(spark, sf_dir)).withColumn("epochs", F.to_json("epochs"))


@query(with_ctes(feeds.SQL_STORED_E, "select distinct epoch from stored"))
def available_epochs(spark, sf_dir):
    return status.available_epochs(feeds.stored_e(spark, sf_dir))


@query(with_ctes(feeds.SQL_STORED_E, "select max(tick) + 1 as start_tick from stored"))
def resume_from(spark, sf_dir):
    return status.resume_from(status.progress(feeds.stored_e(spark, sf_dir)), initial_tick=1)


# ------------------------------------------------------------ metrics

_TYPE_NAME_SQL = type_name("type")


@query(
    with_ctes(
        feeds.SQL_FEED_E,
        f"""select type, {_TYPE_NAME_SQL} as type_name, count(*) filter (ok) as received, count(*) filter (ok) as processed,
              count(*) filter (not ok) as skipped_not_ok from logs group by type""",
    )
)
def metrics_by_type(spark, sf_dir):
    return metrics.metrics_by_type(feeds.parsed_e(spark, sf_dir))


@query(
    with_ctes(
        feeds.SQL_ROUTED_E,
        f"""select logType as type, {type_name("logType")} as type_name, reason as failure_reason, count(*) as failed
            from routed where status = 'failed' group by logType, reason""",
    )
)
def failures_by_reason(spark, sf_dir):
    failed = feeds.routed_e(spark, sf_dir).filter("status = 'failed'")
    return metrics.failures_by_reason(failed, "logType", "reason")


@query(
    with_ctes(
        feeds.SQL_FEED_E,
        f"""select type, {_TYPE_NAME_SQL} as type_name, 'parse_error' as failure_reason, count(*) as failed
            from logs where ok and type in (8, 14) group by type""",
    )
)
def bridge_failures(spark, sf_dir):
    """Bodies of types 8 and 14 with their first text turned into a number no longer parse."""
    logs = feeds.feed_e(spark, sf_dir).withColumn(
        "body",
        F.when(F.col("type").isin(8, 14), F.regexp_replace("body", '"U(\\d+)"', "$1")).otherwise(F.col("body")),
    )
    return metrics.failures_by_reason(metrics.bridge_failures(parse_body(logs)))


@query(
    with_ctes(
        feeds.SQL_MESSAGES_E,
        f"""select type, {_TYPE_NAME_SQL} as type_name, '{_TOPIC}' as topic, count(*) as published from messages group by type""",
    )
)
def published_by_topic(spark, sf_dir):
    return metrics.published_by_topic(feeds.topic_e(spark, sf_dir), _TOPIC)


@query(
    with_ctes(
        feeds.SQL_ENRICHED_E,
        """select max(epoch) as current_epoch, max(tick) as last_tick, arg_max(log_id, tick * 1000000 + index_in_tick) as last_log_id,
             (select count(*) from enr where tick = (select max(tick) from enr)) as events_in_tick from enr""",
    )
)
def state_gauges(spark, sf_dir):
    return metrics.state_gauges(enrich.index_in_tick(enrich.ok_logs(feeds.feed_e(spark, sf_dir))))


@query(
    with_ctes(
        feeds.SQL_ROUTED_E,
        """select count(*) as processed, max(tickNumber) as tick, arg_max(epoch, tickNumber) as epoch
           from routed where status = 'processed'""",
    )
)
def consumer_gauges(spark, sf_dir):
    return metrics.consumer_gauges(feeds.routed_e(spark, sf_dir))


@query(
    with_ctes(
        feeds.SQL_FEED_E,
        """select count(*) filter (ok) as received, count(*) filter (ok) as processed, cast(0 as bigint) as deduplicated,
             cast(0 as bigint) as failed, cast(0 as bigint) as pending, true as balanced from logs""",
    )
)
def metric_balance(spark, sf_dir):
    return metrics.metric_balance(feeds.parsed_e(spark, sf_dir))


# ------------------------------------------------------------ all types


@query(
    with_ctes(
        feeds.SQL_FEED_T, "select log_id, type, case when parse_error is null then body end as body, parse_error from typed"
    )
)
def typed_bodies(spark, sf_dir):
    """Bodies of all 17 types, some of which do not fit their type."""
    rows = feeds.parsed_t(spark, sf_dir)
    return rows.select("log_id", "type", F.expr(f"case when parse_error is null then {source_body_json()} end").alias("body"), "parse_error")


@query(with_ctes(feeds.SQL_ROUTED_T, f"select {_ROUTED} from routed where status = 'processed'"))
def typed_documents(spark, sf_dir):
    """Documents of all types that give one."""
    return feeds.routed_t(spark, sf_dir).filter("status = 'processed'").select(*DOCUMENT_COLUMNS)


@query(with_ctes(feeds.SQL_ROUTED_T, "select logId, logType, status, reason from routed"))
def typed_routes(spark, sf_dir):
    """What becomes of each record of all types, and why."""
    return feeds.routed_t(spark, sf_dir).select("logId", "logType", "status", "reason")


@query(with_ctes(feeds.SQL_FEED_T, "select tx_hash, good_hash as valid, count(*) as logs from typed where ok group by tx_hash, good_hash"))
def digest_verdicts(spark, sf_dir):
    """Sixty hashes, a third of them spoiled in their key, their checksum or their length."""
    return documents.identity_verdicts(enrich.ok_logs(feeds.feed_t(spark, sf_dir)))


@query(
    with_ctes(
        feeds.SQL_FEED_T,
        f"""select type, {_TYPE_NAME_SQL} as type_name, 'parse_error' as failure_reason, count(*) as failed
            from typed where ok and parse_error is not null group by type""",
    )
)
def typed_failures(spark, sf_dir):
    return metrics.failures_by_reason(metrics.bridge_failures(feeds.parsed_t(spark, sf_dir)))


@query(
    with_ctes(
        feeds.SQL_FEED_T,
        """select count(*) filter (ok) as received, count(*) filter (ok and parse_error is null) as processed, cast(0 as bigint) as deduplicated,
             count(*) filter (ok and parse_error is not null) as failed, cast(0 as bigint) as pending, true as balanced from typed""",
    )
)
def typed_balance(spark, sf_dir):
    """Received is processed and failed together, with failures among them."""
    return metrics.metric_balance(feeds.parsed_t(spark, sf_dir))
