"""The streaming jobs as queries: the same feed, sent through files, must give the batch result."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.operators import events, metrics, status
from tickflow.operators.documents import route_records
from tickflow.operators.messages import build_event_message
from tickflow.operators.validate import parse_supported
from tickflow.plans import catalog, feeds
from tickflow.scratch import scratch_dir, written
from tickflow.schemas import DOCUMENT_COLUMNS
from tickflow.sinks.files import publish_ndjson, write_event_ndjson
from tickflow.sinks.tables import PROGRESS_SCHEMA, events_table, newest_state, read_documents, read_events
from tickflow.sources.tick_stream import parse_messages, read_rpc_logs, read_tick_stream
from tickflow.sources.topic import read_event_ndjson
from tickflow.streaming.bridge import OUT_OF_SCOPE, BridgeTables, run_bridge, start_position
from tickflow.streaming.index import IndexTables, read_height, read_highest_tick, run_index, run_tick_height
from tickflow.streaming.replay import run_replay


#: Rows per file of the written feeds, and files per micro-batch beyond the least number of batches: a batch has some fifty jobs
#: whatever its size, so it takes enough rows to outweigh them.
_FILE_MESSAGES = 100_000
_BATCH_FILES, _BATCH_RECORD_FILES = 16, 32


def _cut(part: Column, files: int) -> Column:
    """Ends of all files but the last: values that part the rows into ``files`` of about equal size."""
    return F.percentile_approx(part, [(i + 1) / files for i in range(files - 1)] or [1.0], max(10_000, 100 * files))


def _after(value: str, ends: list) -> str:
    """SQL: how many of ``ends`` lie below a value."""
    return f"cast(size(filter(array({', '.join(f'{e}L' for e in ends)}), x -> x < {value})) as int)" if ends else "0"


def arrivals(rows: DataFrame, path: str, order: list[str], batches: list[list[int]]) -> Iterator[None]:
    """``value`` of rows in text files, one per number in ``__file``, that appear in ``path`` a batch at a time: after each step the
    files of the next batch stand there, whole, and no others follow before the caller goes on.

    All files are written at once beside ``path``, every row once, and moved there; their names go on in the order of arrival.
    """
    spark, staged = rows.sparkSession, f"{path}-{uuid.uuid4().hex}.staged"
    numbers = [i for batch in batches for i in batch]
    rows = rows.repartitionById(max(numbers) + 1, "__file").sortWithinPartitions("__file", *order)
    rows.select("value", "__file").write.partitionBy("__file").text(staged)
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    files = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(to_path(path))
    here = len(files.listStatus(to_path(path)))
    for batch in batches:
        before = here
        for i in batch:
            folder = to_path(f"{staged}/__file={i}")
            for found in files.listStatus(folder) if files.exists(folder) else []:
                if not files.rename(found.getPath(), to_path(f"{path}/{here:08d}.txt")):
                    raise OSError(f"cannot move {found.getPath().toString()}")
                here += 1
        if here > before:
            yield


def in_batches(files: int, batches: int, at_most: int) -> list[list[int]]:
    """Numbers of files in even groups: ``batches`` of them, or as many as it takes for ``at_most`` files in each."""
    n = max(batches, -(-files // at_most))
    return [list(range(i * files // n, (i + 1) * files // n)) for i in range(n)]


def messages_in_order(messages: DataFrame, path: str, batches: int = 4) -> Iterator[None]:
    """Message text that arrives in ``path`` in order of ``msg_seq``, in at least so many batches."""
    messages = messages.filter("msg_seq is not null")
    n = messages.count()
    if not n:
        return
    files = max(batches, -(-n // _FILE_MESSAGES))
    ends = messages.agg(_cut(F.col("msg_seq"), files)).first()[0][: files - 1]
    numbered = messages.withColumn("__file", F.expr(_after("msg_seq", ends)))
    yield from arrivals(numbered, path, ["msg_seq", "tick", "copy"], in_batches(files, batches, _BATCH_FILES))


def _run_bridge(spark, sent: list[tuple[DataFrame, int]], **options) -> BridgeTables:
    """The bridge over feeds that are sent one after another, each in at least so many micro-batches. It takes what has arrived and
    ends, and goes on from its checkpoint when more is there. The files do not say in which order their messages are but by the
    order of their lines."""
    root = scratch_dir(spark, "bridge")
    for messages, batches in sent:
        messages = messages if "copy" in messages.columns else messages.withColumn("copy", F.lit(0))
        for _ in messages_in_order(messages, f"{root}/messages", batches):
            stream = read_tick_stream(spark, f"{root}/messages", streaming=True)
            run_bridge(stream, root, f"{root}/checkpoint", feeds.METHOD, **options).awaitTermination()
    return BridgeTables(root)


def _bridge(spark, sf_dir, messages: DataFrame | None = None, **options) -> BridgeTables:
    """The bridge over the feed in several micro-batches."""
    return _run_bridge(spark, [(feeds.feed_messages(spark, sf_dir) if messages is None else messages, 4)], **options)


def _records(spark, sf_dir, root: str, steps: int) -> Iterator[None]:
    """The feed's topic records, which arrive in ``root/records`` in at least six steps, ``steps`` of them at a time. Ticks are dealt
    in three parts; of each, the records that say how large a tick is come later than the others, so most ticks are completed after
    others above them. Inside a step they are in the order of their ticks."""
    step = "case when contains(value, '\"lastLogForTick\":true') then element_at(array(2, 4, 5), part) else element_at(array(0, 1, 3), part) end"
    rows = feeds.topic_e(spark, sf_dir).selectExpr("value", "tick", "`index`", "cast(pmod(xxhash64(tick), 3) + 1 as int) part")
    rows = written(rows.selectExpr("value", "tick", "`index`", f"{step} step"), "records")
    sizes = {r["step"]: r["count"] for r in rows.groupBy("step").count().collect()}
    files = {s: 1 + sizes[s] // _FILE_MESSAGES for s in sorted(sizes)}
    if not files:
        return
    ends = rows.agg(*[_cut(F.when(F.col("step") == s, F.col("tick")), n).alias(f"s{s}") for s, n in files.items()]).first()
    number, first, batches = "case step", 0, {}
    for s, n in files.items():
        number += f" when {s} then {first} + {_after('tick', ends[f's{s}'][: n - 1])}"
        batches.setdefault(s // steps, []).extend(range(first, first + n))
        first += n
    batches = [[group[i] for i in batch] for group in batches.values() for batch in in_batches(len(group), 1, _BATCH_RECORD_FILES)]
    yield from arrivals(rows.withColumn("__file", F.expr(number + " end")), f"{root}/records", ["tick", "`index`"], batches)


def _index(spark, sf_dir) -> IndexTables:
    """Index the feed in at least three micro-batches; bad records go to the error table."""
    root = scratch_dir(spark, "index")
    for _ in _records(spark, sf_dir, root, steps=2):
        records = read_event_ndjson(spark, f"{root}/records", streaming=True)
        run_index(records, root, f"{root}/checkpoint", mode="quarantine").awaitTermination()
    return IndexTables(root)


@catalog.query(catalog.with_ctes(feeds.SQL_STORED_E, "select * from stored"))
def stream_events(spark, sf_dir):
    return read_events(spark, _bridge(spark, sf_dir).events)


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_MESSAGES_E,
        f'select {feeds.SQL_TOPIC_VALUE} as "value" from messages',
    )
)
def stream_topic(spark, sf_dir):
    return spark.read.text(_bridge(spark, sf_dir).topic).select("value")


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_ROUTED_E,
        "select concat(epoch, '-', logId) as doc_id, "
        + ", ".join(f'"{c}"' for c in DOCUMENT_COLUMNS)
        + " from routed where status = 'processed'",
    )
)
def stream_documents(spark, sf_dir):
    return read_documents(spark, _index(spark, sf_dir).documents).select("doc_id", *DOCUMENT_COLUMNS)


@catalog.query(catalog.ORACLES["highest_tick"])
def stream_tick_height(spark, sf_dir):
    """Counters as streaming state, over six micro-batches."""
    root = scratch_dir(spark, "height")
    for _ in _records(spark, sf_dir, root, steps=1):
        records = read_event_ndjson(spark, f"{root}/records", streaming=True)
        run_tick_height(records, root, f"{root}/checkpoint").awaitTermination()
    return read_height(spark, IndexTables(root))


@catalog.query(catalog.ORACLES["highest_tick"])
def stream_pruned_height(spark, sf_dir):
    """Counters of the index job, which drops those below the height, over three micro-batches."""
    return read_highest_tick(spark, _index(spark, sf_dir)).select("tick", F.col("processed"))


def _resent_part(spark, sf_dir, **options) -> BridgeTables:
    """The feed in order, and then every tenth message once more."""
    messages = feeds.feed_messages(spark, sf_dir)
    return _run_bridge(spark, [(messages, 3), (messages.filter("msg_seq % 10 = 0"), 2)], **options)


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_ENRICHED_E,
        """, marks as (select epoch, row_number() over (order by epoch desc) > 2 as gone from (select distinct epoch from enr))
           select epoch, case when gone then null else count(*) end as events,
             case when gone then count(*) filter (msg_seq % 10 = 0) end as rejected
           from enr join marks using (epoch) group by epoch, gone
           having not gone or count(*) filter (msg_seq % 10 = 0) > 0""",
    )
)
def stream_retention(spark, sf_dir):
    """Two epochs are kept; what is sent again of the others is rejected."""
    tables = _resent_part(spark, sf_dir, mode="quarantine", keep_epochs=2)
    stored = read_events(spark, tables.events).groupBy("epoch").agg(F.count(F.lit(1)).alias("events"))
    errors = spark.read.parquet(tables.errors).filter(F.col("reason") == OUT_OF_SCOPE)
    return stored.join(errors.groupBy("epoch").agg(F.count(F.lit(1)).alias("rejected")), "epoch", "full")


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_ENRICHED_E,
        """select epoch, min(tick) as first_tick, max(tick) as last_tick, count(*) as total_events,
             count(*) + count(*) filter (msg_seq % 10 = 0) as deliveries from enr group by epoch""",
    )
)
def stream_status(spark, sf_dir):
    """Status as the bridge keeps it, without a look at the events; resent ones count once, and as deliveries."""
    events = events_table(spark, _resent_part(spark, sf_dir).events)
    delivered = events.status(delivered=True).select("epoch", F.col("total_events").alias("deliveries"))
    return events.status().join(delivered, "epoch")


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_ENRICHED_E,
        """, wanted as (select distinct tick from enr where tick % 50 = 0 union select min(tick) - 1 from enr)
           select w.tick, coalesce(e.epoch, 0) as epoch, e.log_id from wanted w left join enr e on w.tick = e.tick""",
    )
)
def stream_lookup(spark, sf_dir):
    """Ticks looked up in the bridge's table; only runs that can hold them are opened."""
    table = events_table(spark, _resent_part(spark, sf_dir).events)
    ticks = written(feeds.feed_by_message(spark, sf_dir).filter("ok").select("tick").distinct(), "ticks")
    wanted = ticks.filter("tick % 50 = 0").union(ticks.agg(F.min("tick") - 1)).distinct()
    return events.events_for_ticks(table.read_for(wanted), wanted).select("tick", "epoch", "log_id")


@catalog.query(catalog.with_ctes(feeds.SQL_BROKEN_E, "select epoch, tick, index_in_tick, log_id, type, reason from rejected"))
def stream_errors(spark, sf_dir):
    """Logs that do not fit, one by one: the others of their messages are published."""
    tables = _bridge(spark, sf_dir, feeds.broken_messages(spark, sf_dir), mode="quarantine")
    return spark.read.parquet(tables.errors).select("epoch", "tick", "index_in_tick", "log_id", "type", "reason")


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_BROKEN_E,
        """select tick, index_in_tick as "index", log_id, case when reason is null then type else 32767 end as type,
             last_log_for_tick, reason, case when reason is not null then type end as rejected_type from broken_enr""",
    )
)
def stream_marked_topic(spark, sf_dir):
    """The topic of a feed with broken logs: every log that is not marked as bad stands in it, rejected ones as a marker."""
    tables = _bridge(spark, sf_dir, feeds.broken_messages(spark, sf_dir), mode="quarantine")
    schema = "tickNumber LONG, index LONG, logId DECIMAL(20,0), type LONG, lastLogForTick BOOLEAN, rejected STRING, rejectedType LONG"
    rows = spark.read.text(tables.topic).select(F.from_json("value", schema).alias("r")).select("r.*")
    return rows.selectExpr(
        "tickNumber tick", "`index`", "logId log_id", "type", "coalesce(lastLogForTick, false) last_log_for_tick", "rejected reason", "rejectedType rejected_type"
    )


_RESENT = """, sent as (select e.*, c.copy, max(pos) over (partition by msg_seq, tick) as last_pos,
                 count(*) over (partition by msg_seq, tick, c.copy) as n, row_number() over (partition by msg_seq, tick, c.copy order by pos) - 1 as place
               from logs e cross join (select unnest([0, 1]) as copy) c where ok),
             base as (select msg_seq, tick, sum(2 * n) over (partition by tick order by msg_seq) - 2 * n as before
                      from (select distinct msg_seq, tick, n from sent))"""


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_FEED_E + _RESENT,
        """select tick, log_id, cast(before + copy * n + place as bigint) as "index", pos = last_pos as last_log_for_tick
           from sent join base using (msg_seq, tick)""",
    )
)
def resent_messages(spark, sf_dir):
    """Every message sent twice in a row: the second copy goes on counting, and has a last log of its own."""
    messages = feeds.feed_messages(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = spark.read.text(_bridge(spark, sf_dir, messages).topic)
    rows = rows.select(F.from_json("value", "tickNumber LONG, logId LONG, index LONG, lastLogForTick BOOLEAN").alias("r")).select("r.*")
    return rows.selectExpr("tickNumber tick", "logId log_id", "`index`", "coalesce(lastLogForTick, false) last_log_for_tick")


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_ENRICHED_E,
        """select tick, log_id, index_in_tick as "index", last_log_for_tick, count(*) as times from enr cross join (select unnest([0, 1]) as copy)
           group by all""",
    )
)
def resent_feed(spark, sf_dir):
    """The whole feed sent again after its end, in batches of its own: ticks that come back are counted from 0 again."""
    messages = feeds.feed_messages(spark, sf_dir)
    rows = spark.read.text(_run_bridge(spark, [(messages, 2), (messages, 2)]).topic)
    rows = rows.select(F.from_json("value", "tickNumber LONG, logId LONG, index LONG, lastLogForTick BOOLEAN").alias("r")).select("r.*")
    rows = rows.selectExpr("tickNumber tick", "logId log_id", "`index`", "coalesce(lastLogForTick, false) last_log_for_tick")
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("times"))


_RPC_MESSAGES = 128


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_FEED_E,
        f"""select msg_seq // {_RPC_MESSAGES} as response, row_number() over (partition by msg_seq // {_RPC_MESSAGES} order by msg_seq, tick, pos) - 1 as pos,
              ok, epoch, tick, type, log_id, log_digest, body_size, coalesce("timestamp", 0) as "timestamp", tx_hash, {feeds.SQL_SOURCE_BODY} as body from logs""",
    )
)
def rpc_logs(spark, sf_dir):
    """Logs out of files of one RPC response each, with up to some thousand logs."""
    path = scratch_dir(spark, "rpc")
    logs = feeds.log_texts(spark, sf_dir).withColumn("response", F.expr(f"msg_seq div {_RPC_MESSAGES}"))
    parts = F.sort_array(F.collect_list(F.struct("msg_seq", "tick", "pos", "log")))
    texts = logs.groupBy("response").agg(F.array_join(F.transform(parts, lambda x: x["log"]), ",").alias("logs"))
    texts = texts.select("response", F.concat(F.lit('{"result":['), "logs", F.lit("]}")).alias("value"))
    texts.repartition("response").write.partitionBy("response").text(path)
    rows = read_rpc_logs(spark, f"{path}/response=*")
    names = ["ok", "epoch", "tick", "type", "log_id", "log_digest", "body_size", "timestamp", "tx_hash"]
    return rows.select(F.regexp_extract("file", "response=([0-9]+)", 1).cast("bigint").alias("response"), "pos", *names, "body")


@catalog.query(catalog.with_ctes(feeds.SQL_MESSAGES_E, f'select {feeds.SQL_TOPIC_VALUE} as "value" from messages'))
def event_ndjson(spark, sf_dir):
    """Event messages written as lines and read again."""
    path = scratch_dir(spark, "ndjson")
    write_event_ndjson(build_event_message(feeds.enriched_e(spark, sf_dir)), path)
    return read_event_ndjson(spark, path)


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_ENRICHED_E,
        """select epoch, log_id as last_log_id, tick as last_tick, index_in_tick + 1 as next_index, tick + 1 as start_tick
           from enr order by tick desc, index_in_tick desc limit 1""",
    )
)
def saved_progress(spark, sf_dir):
    """What the bridge has saved after its last batch, and the tick from which it would go on."""
    tables = _bridge(spark, sf_dir)
    saved = newest_state(spark, tables.progress, PROGRESS_SCHEMA).select("epoch", "last_log_id", "last_tick", "next_index")
    return saved.withColumn("start_tick", start_position(spark, tables, initial_tick=1).scalar())


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_ROUTED_E,
        """select logType, case when reason like 'zero %' and reason <> 'zero amount' then 'failed' when logType not in (1, 6, 8) then 'skipped' else status end as status,
             count(*) as records from routed group by all""",
    )
)
def configured_types(spark, sf_dir):
    """Routing with the supported types read from their configured text."""
    types = parse_supported('{"0": [1, 6, 8], "1": [0]}')
    routed = route_records(feeds.topic_e(spark, sf_dir).select("value"), types)
    return routed.groupBy("logType", "status").agg(F.count(F.lit(1)).alias("records"))


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_FEED_E,
        """select concat('jsonrpc_', -32000 - msg_seq % 3) as error_code, count(distinct (msg_seq, tick)) as errors from logs where msg_seq % 20 = 4 group by all""",
    )
)
def rpc_errors(spark, sf_dir):
    """Error responses among the messages, by code."""
    error = F.expr("""concat('{"jsonrpc":"2.0","id":7,"error":{"code":', -32000 - msg_seq % 3, ',"message":"no"}}')""")
    messages = feeds.feed_messages(spark, sf_dir).withColumn("value", F.when(F.expr("msg_seq % 20 = 4"), error).otherwise(F.col("value")))
    return metrics.rpc_errors(parse_messages(messages, feeds.METHOD))


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_STORED_E,
        f"""select s.tick, s.log_id, s.index_in_tick as "index", m.body from stored s join (select log_id, {feeds.SQL_TOPIC_BODY} body from logs) m using (log_id)
            where epoch = 2 and s.tick % 2 = 0""",
    )
)
def replayed_topic(spark, sf_dir):
    """Epoch 2 replayed out of the bridge's table into a topic of its own, and read there."""
    tables = _bridge(spark, sf_dir)
    path = scratch_dir(spark, "replay")
    run_replay(read_events(spark, tables.events, epoch=2), lambda rows, batch: publish_ndjson(rows, path), epoch=2)
    fields = ["tickNumber", "logId", "index", "body"]
    rows = spark.read.text(path).select(F.json_tuple("value", *fields).alias("tick", "log_id", "index", "body"))
    return rows.selectExpr("cast(tick as bigint) tick", "cast(log_id as bigint) log_id", "cast(`index` as bigint) `index`", "body").filter("tick % 2 = 0")


@catalog.query(
    catalog.with_ctes(
        feeds.SQL_ENRICHED_E,
        """select epoch, min(tick) as first_tick, max(tick) as last_tick, (select count(*) from enr e where e.epoch = 2 and e.tick = (select min(tick) from enr where epoch = 2)) as events
           from enr where epoch = 2 group by epoch""",
    )
)
def epoch_tick_range(spark, sf_dir):
    """Tick range of an epoch, and the number of events of its first tick."""
    stored = feeds.stored_e(spark, sf_dir)
    one = status.epoch_tick_range(stored, 2)
    first = one.select("first_tick").first()
    return one.withColumn("events", status.count_events_for_tick(stored, 2, first["first_tick"] if first else 1).scalar())
