"""Log feeds derived from the given tables, for Spark and, as SQL text, for DuckDB.

Feed E maps every row of ``events`` to one raw log: tick = hour, epoch =
week, a message = up to 8 neighbouring events of one tick. Feed L maps every
row of ``lineitem`` to a delivered event: tick = day, epoch = year; many of
its keys arrive more than once. Both are narrow projections: no shuffle.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.identity import digest_of
from tickflow.operators.bodies import parse_body
from tickflow.operators.documents import route_records
from tickflow.operators.enrich import enrich, ok_logs
from tickflow.operators.messages import build_event_message, to_stored_event, to_topic_rows

#: Digests with a right checksum.
DIGESTS = digest_of(np.arange(1, 4 * 60 + 1, dtype=np.uint64).reshape(60, 4) * np.uint64(0x9E3779B97F4A7C15))
DIGEST = DIGESTS[0]

#: Log ids, modulo 100, whose text is changed: pattern, replacement, and the reason for which the log is rejected.
BROKEN_LOGS = {
    3: ('"epoch":[0-9]+', '"epoch":70000', "epoch"),
    23: ('"tick":[0-9]+', '"tick":1099511627776', "tick"),
    43: ('"logDigest":"[^"]*"', '"logDigest":5', "logDigest"),
    63: ('"body":[{].*', '"body":[1]}', "body"),
    83: ('"ok":(true|false)', '"ok":"yes"', "ok"),
}
#: Every so many messages one is cut before its end.
_CUT_EVERY, _CUT_AT = 40, 7

#: The subscription whose notifications carry the feed.
METHOD = "log_subscription"

_LOG_COLUMNS = f"""
  {{seq}} msg_seq, event_id % 8 pos, k <> 99 ok, epoch, tick,
  case event_type when 'click' then 0 when 'signup' then 1 when 'purchase' then 8
    when 'error' then case when k < 33 then 6 when k < 66 then 7 else 13 end
    else case when k < 60 then 255 else 14 end end type,
  event_id log_id,
  case when k = 98 then '' else printf('%016x', event_id * 7919) end log_digest,
  cast(72 as bigint) body_size,
  case when k = 97 then null else sec end timestamp,
  case when k % 10 < 6 then '{DIGEST}'
    when k % 10 = 6 then concat('SC_END_TICK_TX_', tick)
    when k % 10 = 7 then concat('SC_BEGIN_TICK_TX_', tick)
    when k % 10 = 8 then concat('SC_NOTIFICATION_TX', tick)
    when k = 89 then 'SC_BAD_TX_1' else '' end tx_hash,
  case event_type
    when 'click' then concat('{{{{"from":"U', user_id, '","to":"U', user_id + 1, '","amount":', amount, '}}}}')
    when 'signup' then concat('{{{{"issuerPublicKey":"I', user_id, '","numberOfShares":', amount,
      ',"managingContractIndex":1,"name":"A', k, '","numberOfDecimalPlaces":0,"unitOfMeasurement":"0000000"}}}}')
    when 'purchase' then concat('{{{{"publicKey":"U', user_id, '","amount":', amount, ',"contractIndexBurnedFor":', k % 20, '}}}}')
    when 'error' then case
      when k < 66 then concat('{{{{"scIndex":', k % 20, ',"scLogType":', k % 5, ',"content":"', printf('%016x', event_id), '"}}}}')
      else concat('{{{{"deductedAmount":', amount, ',"remainingAmount":', amount - 50, ',"contractIndex":', k % 20, '}}}}') end
    else case
      when k < 20 then '{{{{"customMessage":"6217575821008262227"}}}}'
      when k < 40 then '{{{{"customMessage":"6217575821008457285"}}}}'
      when k < 60 then concat('{{{{"customMessage":"', k, '"}}}}')
      else concat('{{{{"queryingEntity":"U', user_id, '","queryId":', event_id, ',"interfaceIndex":', k % 7, ',"type":', k % 3, ',"status":"',
        case k % 5 when 0 then 'pending' when 1 then 'committed' when 2 then 'success' when 3 then 'timeout' else 'unresolvable' end, '"}}}}') end
  end body"""


def _log_columns(seq: str) -> str:
    return _LOG_COLUMNS.format(seq=seq).replace("{{", "{").replace("}}", "}")


def _spark_hex(columns: str) -> str:
    """``printf('%016x', n)`` in the functions Spark compiles."""
    return re.sub(r"printf\('%016x', ([^)]*)\)", r"lpad(lower(hex(\1)), 16, '0')", columns)


def _hash(digest: str, i: int) -> str:
    """Every third digest is spoiled: a letter of the key, a letter of the checksum, or its length."""
    if i % 3:
        return digest
    spoiled = {0: digest[:20] + chr((ord(digest[20]) - 96) % 26 + 97) + digest[21:], 1: digest[:-1] + chr((ord(digest[-1]) - 96) % 26 + 97), 2: digest[:-1]}
    return spoiled[i // 3 % 3]


#: Transaction hashes of feed T, by log id.
HASHES = [_hash(d, i) for i, d in enumerate(DIGESTS)]

#: Feed T is feed E with the 17 types in turn; ``n`` counts the rounds. Of every ten logs of a type some have a body that does not fit
#: the type, or that gives no document. Keys are in order, so that a body is its own canonical text.
_T_TYPE = "case log_id % 17 when 16 then 255 else log_id % 17 end"
_T_N = "cast(floor(log_id / 17) as bigint) % 1000"
_T_HASH = "case " + " ".join(f"when log_id % {len(HASHES)} = {i} then '{h}'" for i, h in enumerate(HASHES)) + " end"
_T_ASSET = """concat('"assetName":"A', n, '","destinationPublicKey":"D', log_id, '","issuerPublicKey":"I', n, '","numberOfShares":',
    case when n % 10 = 0 then -5 else n * 1000 end, ',"sourcePublicKey":"S', n, '"}')"""
_T_MANAGED = """concat('"assetName":"A', n, '","destinationContractIndex":', n % 31, ',"issuerPublicKey":"I', n, '","numberOfShares":', n,
    ',"ownershipPublicKey":"O', log_id, '",', case when type = 12 then concat('"possessionPublicKey":"P', n, '",') else '' end,
    '"sourceContractIndex":', case when n % 10 = 3 then 4294967296 else n % 30 end, '}')"""
_T_BODY = f"""concat('{{', case
  when type = 0 then concat('"amount":', case when n % 10 = 8 then '"many"' when n % 10 = 9 then '0' else concat('', n) end,
    ',"from":"F', n, '","to":"T', log_id, '"}}')
  when type = 1 then concat('"issuerPublicKey":"I', n, '","managingContractIndex":', n % 7, ',"name":"N', n, '","numberOfDecimalPlaces":',
    case when n % 10 = 1 then 300 else n % 9 end, ',"numberOfShares":', n, ',"unitOfMeasurement":"0000000"}}')
  when type in (2, 3) then {_T_ASSET}
  when type in (4, 5, 6, 7) then concat('"content":"', case when n % 10 = 1 then 'abc' else concat('aB', lpad(concat('', n), 6, '0')) end,
    '","scIndex":', n % 20, ',"scLogType":', n % 5, '}}')
  when type = 8 then concat('"amount":', n, ',"contractIndexBurnedFor":', case when n % 10 = 4 then -1 else n % 20 end, ',"publicKey":"K', n, '"}}')
  when type in (9, 10) then concat('"hex":"', case when n % 10 = 2 then 'zz' else lpad(concat('', n), 4, '0') end, '"}}')
  when type in (11, 12) then {_T_MANAGED}
  when type = 13 then concat('"contractIndex":', n % 20, ',"deductedAmount":', case when n % 10 = 4 then '18446744073709551616' else '9007199254740992' end,
    ',"remainingAmount":', n - 500, '}}')
  when type = 14 then concat('"interfaceIndex":', n % 7, ',"queryId":', n - 3, ',"queryingEntity":"Q', n, '","status":"',
    case when n % 10 = 5 then 'lost' when n % 10 < 5 then 'success' else 'pending' end, '","type":', n % 40, '}}')
  when type = 15 then concat('"contractIndex":', n, ',"firstQueryDateAndTime":"', case when n % 10 = 7 then '12025' else '2024' end,
    '-02-29 10:20:30.045''678","interfaceIndex":', n % 5, ',"periodInMilliseconds":', n * 10, ',"subscriptionId":', case when n % 10 = 6 then -1 else n end, '}}')
  else concat('"customMessage":"', case when n % 10 = 8 then 'x1' else concat('', n) end, '"}}') end)"""

_FEED_L_COLUMNS = """
  epoch, tick, l_orderkey * 8 + l_linenumber log_id,
  l_linestatus = 'O' or l_returnflag <> 'A' ok,
  cast(case l_returnflag when 'N' then 0 when 'A' then 8 else 2 end as bigint) type,
  case when l_discount = 0 then cast(0 as bigint) else cast(floor(l_extendedprice) as bigint) end amount,
  concat('S', l_suppkey) source, concat('P', l_partkey) destination,
  l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"""

#: What orders the deliveries of one key of feed L (the table itself has no arrival column).
FEED_L_ARRIVAL = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def feed_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log rows: msg_seq, pos, ok, epoch, tick, type, log_id, ..., body (JSON text)."""
    return _logs(_event_rows(spark, sf_dir))


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ``events`` with the number of their message."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("seq", F.expr("event_id div 8"))


def _logs(events: DataFrame) -> DataFrame:
    """Rows of ``events`` -> raw logs."""
    rows = events.selectExpr(
        "seq msg_seq",
        "event_id",
        "user_id",
        "event_type",
        "cast(floor(value) as bigint) amount",
        "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz)) div 1000000 sec",
        "cast(get_json_object(props, '$.k') as bigint) k",
    )
    ticks = rows.selectExpr("*", "sec div 3600 tick", "1 + (sec - 1704067200) div 604800 epoch")
    # What names a message is taken beside the struct, where Spark sees that rows lie by it already.
    keys = ["msg_seq", "tick", "epoch"]
    made = ticks.select(*keys, F.expr(f"struct({_spark_hex(_log_columns('msg_seq'))})").alias("log"))
    logs = made.select(*[c if c in keys else f"log.{c}" for c in made.schema["log"].dataType.names])
    return logs.withColumn("type", F.col("type").cast("bigint"))


def feed_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered events: epoch, tick, log_id, ok, type, amount, source, destination and the arrival order."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "*",
        "cast(unix_date(cast(l_shipdate as date)) as bigint) tick",
        "cast(year(l_shipdate) as bigint) epoch",
    )
    return rows.select(F.expr(f"struct({_FEED_L_COLUMNS})").alias("log")).select("log.*")


def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed E as message text, one row per message (a group of at most 8 logs)."""
    return _as_messages(_texts(feed_by_message(spark, sf_dir)))


def log_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text of every log of feed E."""
    return _texts(feed_e(spark, sf_dir))


def feed_by_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed E with the logs of a message in one task. The rows of the table are shuffled as they are, and logs and texts are made
    after that: a table is read by as few tasks as it has row groups, one for a million events or more."""
    return _logs(_event_rows(spark, sf_dir).repartition("seq"))


def _texts(logs: DataFrame) -> DataFrame:
    log = F.struct(
        "pos",
        "ok",
        F.col("epoch"),
        F.col("tick"),
        F.col("type"),
        F.col("log_id").alias("logId"),
        F.col("log_digest").alias("logDigest"),
        F.col("body_size").alias("bodySize"),
        F.col("timestamp"),
        F.col("tx_hash").alias("txHash"),
        F.try_parse_json("body").alias("body"),
    )
    return logs.select("msg_seq", "tick", "epoch", "pos", "log_id", F.to_json(log).alias("log"))


def broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed E with logs that do not fit (by their log id), and with messages that end early (by their number)."""
    texts = _texts(feed_by_message(spark, sf_dir))
    log = F.col("log")
    for rest, (pattern, by, _) in BROKEN_LOGS.items():
        log = F.when(F.col("log_id") % 100 == rest, F.regexp_replace("log", pattern, by)).otherwise(log)
    messages = _as_messages(texts.withColumn("log", log))
    cut = F.expr(f"case when msg_seq % {_CUT_EVERY} = {_CUT_AT} then substring(value, 1, length(value) - 3) else value end")
    return messages.withColumn("value", cut)


def _as_messages(texts: DataFrame) -> DataFrame:
    grouped = texts.groupBy("msg_seq", "tick", "epoch").agg(F.sort_array(F.collect_list(F.struct("pos", "log"))).alias("logs"))
    logs = F.array_join(F.transform("logs", lambda x: x["log"]), ",")
    return grouped.select(
        "msg_seq",
        "tick",
        F.concat(
            F.lit('{"jsonrpc":"2.0","method":"' + METHOD + '","params":{"subscription":"s1","result":{"epoch":'),
            F.col("epoch"),
            F.lit(',"tick":'),
            F.col("tick"),
            F.lit(',"isCatchUp":false,"logs":['),
            logs,
            F.lit("]}}}"),
        ).alias("value"),
    )


def feed_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed E's logs with all types, many digests, and bodies that fit or not."""
    rows = feed_e(spark, sf_dir).drop("type", "tx_hash", "body")
    rows = rows.selectExpr("*", f"cast({_T_TYPE} as bigint) type", f"{_T_HASH} tx_hash", f"{_T_N} n")
    return rows.selectExpr("*", f"{_spark_quotes(_T_BODY)} body").drop("n")


def _spark_quotes(text: str) -> str:
    """A quote inside a text, as Spark writes it."""
    return text.replace("''678", "\\'678")


def parsed_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_body(feed_t(spark, sf_dir))


def routed_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the logs of feed T whose bodies fit."""
    rows = parse_body(enrich(ok_logs(feed_t(spark, sf_dir)))).filter("parse_error is null")
    return route_records(to_topic_rows(build_event_message(rows)).select("value"))


def parsed_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of feed E with typed bodies."""
    return parse_body(feed_e(spark, sf_dir))


def enriched_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered and flagged ok logs. Bodies are parsed after the shuffle, so it moves raw text only."""
    return parse_body(enrich(ok_logs(feed_e(spark, sf_dir))))


def topic_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_topic_rows(build_event_message(enriched_e(spark, sf_dir)))


def stored_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_stored_event(enriched_e(spark, sf_dir))


def routed_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: raw logs -> topic JSON -> routed documents."""
    return route_records(topic_e(spark, sf_dir).select("value"))


# ---------------------------------------------------------------- DuckDB text

SQL_FEED_E = f"""
e as (
  select event_id, user_id, event_type, cast(floor(value) as bigint) amount,
         epoch_us(ts) // 1000000 sec, cast(json_extract_string(props, '$.k') as bigint) k
  from events),
t as (select *, cast(sec // 3600 as bigint) tick, cast(1 + (sec - 1704067200) // 604800 as bigint) epoch from e),
logs0 as (select {_log_columns('event_id // 8')} from t),
logs as (select * replace (cast(type as bigint) as type) from logs0)"""

SQL_ENRICHED_E = (
    SQL_FEED_E
    + """,
marked as (
  select *, case when type = 255 then case json_extract_string(body, '$.customMessage')
    when '6217575821008262227' then 1 when '6217575821008457285' then 0 end end marker
  from logs where ok),
enr as (
  select * exclude (marker),
    row_number() over (partition by tick order by msg_seq, pos) - 1 index_in_tick,
    pos = max(pos) over (partition by tick, msg_seq) last_log_for_tick,
    marker is null and coalesce(last_value(marker ignore nulls) over (
      partition by tick order by msg_seq, pos rows between unbounded preceding and current row), 0) = 1 dividend
  from marked)"""
)


_REASONS = " ".join(f"when {rest} then '{reason}'" for rest, (_, _, reason) in BROKEN_LOGS.items())
#: ``broken_enr``: logs that are not marked as bad, of messages that can be read. ``rejected``: those with a reason, and the cut messages.
SQL_BROKEN_E = (
    SQL_FEED_E
    + f""",
broken_logs as (
  select *, case log_id % 100 {_REASONS} end reason from logs where msg_seq % {_CUT_EVERY} <> {_CUT_AT} and (ok or log_id % 100 = 83)),
broken_enr as (
  select *, row_number() over (partition by tick order by msg_seq, pos) - 1 index_in_tick,
    pos = max(pos) over (partition by tick, msg_seq) last_log_for_tick from broken_logs),
rejected as (
  select epoch, tick, index_in_tick, log_id, type, reason from broken_enr where reason is not null
  union all
  select distinct on (msg_seq, tick) null, null, null, null, null, 'malformed message' from logs where msg_seq % {_CUT_EVERY} = {_CUT_AT})"""
)


def _j(key: str) -> str:
    return f"json_extract_string(body, '$.{key}')"


def _object(**pairs: str) -> str:
    """SQL that writes a JSON object; a leading ' marks a text value."""
    parts = []
    for key, value in pairs.items():
        column = _j(value.lstrip("'"))
        text = f"concat('\"', {column}, '\"')" if value.startswith("'") else column
        parts.append(f"'\"{key}\":', {text}")
    return "concat('{', " + ", ',', ".join(parts) + ", '}')"


#: Body JSON with sorted source keys and with sorted topic keys, per type of feed E.
SQL_SOURCE_BODY = f"""case
  when type = 0 then {_object(amount="amount", **{"from": "'from"}, to="'to")}
  when type = 1 then {_object(issuerPublicKey="'issuerPublicKey", managingContractIndex="managingContractIndex", name="'name", numberOfDecimalPlaces="numberOfDecimalPlaces", numberOfShares="numberOfShares", unitOfMeasurement="'unitOfMeasurement")}
  when type in (6, 7) then {_object(content="'content", scIndex="scIndex", scLogType="scLogType")}
  when type = 8 then {_object(amount="amount", contractIndexBurnedFor="contractIndexBurnedFor", publicKey="'publicKey")}
  when type = 13 then {_object(contractIndex="contractIndex", deductedAmount="deductedAmount", remainingAmount="remainingAmount")}
  when type = 14 then {_object(interfaceIndex="interfaceIndex", queryId="queryId", queryingEntity="'queryingEntity", status="'status", type="type")}
  else body end"""
SQL_TOPIC_BODY = f"""case
  when type = 0 then {_object(amount="amount", destination="'to", source="'from")}
  when type = 1 then {_object(assetIssuer="'issuerPublicKey", assetName="'name", managingContractIndex="managingContractIndex", numberOfDecimalPlaces="numberOfDecimalPlaces", numberOfShares="numberOfShares", unitOfMeasurement="'unitOfMeasurement")}
  when type in (6, 7) then {_object(content="'content", scIndex="scIndex", scLogType="scLogType")}
  when type = 8 then {_object(amount="amount", contractIndexBurnedFor="contractIndexBurnedFor", source="'publicKey")}
  when type = 13 then {_object(contractIndex="contractIndex", deductedAmount="deductedAmount", remainingAmount="remainingAmount")}
  when type = 14 then {_object(interfaceIndex="interfaceIndex", queryId="queryId", queryingEntity="'queryingEntity", status="'status", type="type")}
  else body end"""

SQL_MESSAGES_E = (
    SQL_ENRICHED_E
    + f""",
messages as (
  select index_in_tick "index", type, tick tickNumber, epoch, log_digest logDigest, log_id logId, body_size bodySize,
    coalesce(timestamp, 0) "timestamp", tx_hash transactionHash, {SQL_TOPIC_BODY} body, dividend,
    last_log_for_tick lastLogForTick
  from enr)"""
)

SQL_TOPIC_VALUE = """concat('{"index":', "index", ',"type":', type, ',"tickNumber":', tickNumber, ',"epoch":', epoch,
    ',"logDigest":"', logDigest, '","logId":', logId, ',"bodySize":', bodySize, ',"timestamp":', "timestamp",
    ',"transactionHash":"', transactionHash, '","body":', body,
    case when dividend then ',"dividend":true' else '' end,
    case when lastLogForTick then ',"lastLogForTick":true' else '' end, '}')"""

SQL_STORED_E = (
    SQL_ENRICHED_E
    + f""",
stored as (
  select epoch, tick, log_id, type event_type, tx_hash, coalesce(timestamp, 0) "timestamp", {SQL_SOURCE_BODY} body,
    index_in_tick, log_digest, last_log_for_tick
  from enr)"""
)

def _n(key: str) -> str:
    return f"cast(json_extract_string(body, '$.{key}') as bigint)"


SQL_ROUTED_E = (
    SQL_MESSAGES_E
    + f""",
classified as (
  select *, case when transactionHash like 'SC_END_TICK_TX_%' then 4 when transactionHash like 'SC_BEGIN_TICK_TX_%' then 3
      when transactionHash like 'SC_NOTIFICATION_TX%' then 6 end category,
    case when logDigest = '' then 'zero logDigest' when "timestamp" = 0 then 'zero timestamp' end early
  from messages),
routed as (
  select epoch, tickNumber, "timestamp" * 1000 "timestamp",
    case when category is null then transactionHash end transactionHash,
    logId, logDigest, type logType,
    nullif(concat_ws(',', category, case when dividend then 7 end), '') categories,
    case when type in (6, 7) then {_n("scIndex")} when type = 8 then {_n("contractIndexBurnedFor")}
      when type = 13 then {_n("contractIndex")} end contractIndex,
    case when type in (6, 7) then {_n("scLogType")} end contractMessageType,
    case when type in (0, 8) then {_j("source")} end source,
    case when type = 0 then {_j("destination")} end destination,
    case when type in (0, 8) then {_n("amount")} end amount,
    case when type = 1 then {_j("assetName")} end assetName,
    case when type = 1 then {_j("assetIssuer")} end assetIssuer,
    case when type = 1 then {_n("numberOfShares")} end numberOfShares,
    case when type = 1 then {_n("managingContractIndex")} end managingContractIndex,
    case when type = 1 then '00000000000000' end unitOfMeasurement,
    case when type = 1 then {_n("numberOfDecimalPlaces")} end numberOfDecimalPlaces,
    case when type = 13 then {_n("deductedAmount")} end deductedAmount,
    case when type = 13 then {_n("remainingAmount")} end remainingAmount,
    cast(null as varchar) "owner", cast(null as varchar) possessor,
    cast(null as bigint) sourceContractIndex, cast(null as bigint) destinationContractIndex,
    case when type = 255 then {_n("customMessage")} end customMessage,
    case when type in (6, 7) then upper({_j("content")}) end rawPayload,
    case when type = 14 then {_j("queryingEntity")} end queryingEntity,
    case when type = 14 then {_n("queryId")} end queryId,
    case when type = 14 then {_n("type")} end queryType,
    case when type = 14 then case {_j("status")} when 'pending' then 1 when 'committed' then 2 when 'success' then 3
      when 'timeout' then 4 else 5 end end queryStatus,
    cast(null as bigint) subscriptionId,
    case when type = 14 then {_n("interfaceIndex")} end interfaceIndex,
    cast(null as bigint) periodMillis, cast(null as bigint) firstQueryTimestamp,
    "index", lastLogForTick,
    case when early is not null then 'failed' when type = 7 then 'skipped'
      when transactionHash = 'SC_BAD_TX_1' then 'failed'
      when type in (0, 8) and {_n("amount")} = 0 then 'skipped' else 'processed' end status,
    case when early is not null then early when type = 7 then 'unsupported type'
      when transactionHash = 'SC_BAD_TX_1' then 'unexpected transaction hash'
      when type in (0, 8) and {_n("amount")} = 0 then 'zero amount' end reason
  from classified)"""
)

SQL_FEED_L = f"""
a as (
  select *, cast(epoch_us(l_shipdate) // 86400000000 as bigint) tick, cast(year(l_shipdate) as bigint) epoch from lineitem),
deliveries as (select {_FEED_L_COLUMNS} from a)"""


SQL_FEED_T = (
    SQL_FEED_E
    + f""",
t1 as (select * replace (cast({_T_TYPE} as bigint) as type, {_T_HASH} as tx_hash), cast({_T_N} as bigint) as n from logs),
t2 as (select * replace ({_T_BODY} as body) from t1),
typed as (select *, case when type = 0 and n % 10 = 8 then 'amount' when type = 8 and n % 10 = 4 then 'contractIndexBurnedFor'
    when type in (11, 12) and n % 10 = 3 then 'sourceContractIndex' when type = 13 and n % 10 = 4 then 'deductedAmount' end as parse_error,
    log_id % {len(HASHES)} % 3 <> 0 as good_hash from t2)"""
)

_STAMP = "epoch_ms(timestamp '2024-02-29 10:20:30.045')"
#: 10,001 years later: 25 eras of 146,097 days and one year, whose day after 28 February is 1 March.
_LATER = "25 * 146097 * 86400000::bigint + epoch_ms(timestamp '2025-03-01 10:20:30.045')"
SQL_ROUTED_T = (
    SQL_FEED_T
    + f""",
judged as (
  select *, case when log_digest = '' then 'zero logDigest' when coalesce("timestamp", 0) = 0 then 'zero timestamp' end as early,
    case when type in (2, 3) and n % 10 = 0 then 'numberOfShares' when type = 1 and n % 10 = 1 then 'numberOfDecimalPlaces'
      when type in (4, 5, 6) and n % 10 = 1 then 'content' when type in (9, 10) and n % 10 = 2 then 'hex'
      when type = 14 and n < 3 then 'queryId' when type = 14 and n % 10 = 5 then 'status'
      when type = 15 and n % 10 = 6 then 'subscriptionId' when type = 255 and n % 10 = 8 then 'customMessage' end as misfit,
    type in (0, 8) and {_n("amount")} = 0 as no_amount
  from typed where ok and parse_error is null),
routed as (
  select epoch, tick tickNumber, "timestamp" * 1000 "timestamp", tx_hash transactionHash, log_id logId, log_digest logDigest, type logType,
    cast(null as varchar) categories,
    case when type in (4, 5, 6) then {_n("scIndex")} when type = 8 then {_n("contractIndexBurnedFor")} when type in (13, 15) then {_n("contractIndex")} end contractIndex,
    case when type in (4, 5, 6) then {_n("scLogType")} end contractMessageType,
    case when type = 0 then {_j("from")} when type in (2, 3) then {_j("sourcePublicKey")} when type = 8 then {_j("publicKey")} end source,
    case when type = 0 then {_j("to")} when type in (2, 3) then {_j("destinationPublicKey")} end destination,
    case when type in (0, 8) then {_n("amount")} end amount,
    case when type = 1 then {_j("name")} when type in (2, 3, 11, 12) then {_j("assetName")} end assetName,
    case when type in (1, 2, 3, 11, 12) then {_j("issuerPublicKey")} end assetIssuer,
    case when type in (1, 2, 3, 11, 12) then {_n("numberOfShares")} end numberOfShares,
    case when type = 1 then {_n("managingContractIndex")} end managingContractIndex,
    case when type = 1 then '00000000000000' end unitOfMeasurement,
    case when type = 1 then {_n("numberOfDecimalPlaces")} end numberOfDecimalPlaces,
    case when type = 13 then {_n("deductedAmount")} end deductedAmount,
    case when type = 13 then {_n("remainingAmount")} end remainingAmount,
    case when type in (11, 12) then {_j("ownershipPublicKey")} end "owner",
    case when type = 12 then {_j("possessionPublicKey")} end possessor,
    case when type in (11, 12) then {_n("sourceContractIndex")} end sourceContractIndex,
    case when type in (11, 12) then {_n("destinationContractIndex")} end destinationContractIndex,
    case when type = 255 and n % 10 <> 8 then {_n("customMessage")} end customMessage,
    case when type in (4, 5, 6) then upper({_j("content")}) when type in (9, 10) then {_j("hex")} end rawPayload,
    case when type = 14 then {_j("queryingEntity")} end queryingEntity,
    case when type = 14 then {_n("queryId")} end queryId,
    case when type = 14 then {_n("type")} end queryType,
    case when type = 14 then case {_j("status")} when 'success' then 3 else 1 end end queryStatus,
    case when type = 15 then {_n("subscriptionId")} end subscriptionId,
    case when type in (14, 15) then {_n("interfaceIndex")} end interfaceIndex,
    case when type = 15 then {_n("periodInMilliseconds")} end periodMillis,
    case when type = 15 then case when n % 10 = 7 then {_LATER} else {_STAMP} end end firstQueryTimestamp,
    case when early is not null then 'failed' when type = 7 then 'skipped' when not good_hash or misfit is not null then 'failed'
      when no_amount then 'skipped' else 'processed' end status,
    case when early is not null then early when type = 7 then 'unsupported type' when not good_hash then 'unexpected transaction hash'
      when misfit is not null then concat('body field ', misfit) when no_amount then 'zero amount' end reason
  from judged)"""
)
