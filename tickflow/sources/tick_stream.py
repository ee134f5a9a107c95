"""Tick-stream messages (JSON-RPC text) and the log rows inside them.

A message is read in two steps: its envelope, which leaves every log as JSON
text, and then each log by itself. So one log that does not fit (a wrong type,
a number out of range) does not take the others of its message with it: it
becomes a row with ``log_error`` and its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.fence import fence
from tickflow.functions.json_text import from_json, suspect_kinds, uint64_field, wrong_kind
from tickflow.functions.numbers import in_range
from tickflow.schemas import INT64_MAX, LOG_FIELDS, LOG_RANGES, MESSAGE_SCHEMA, UINT16_MAX, UINT32_MAX

#: Where a message of a file or topic stands: what parts the source, and the order inside a part.
FILE_PLACE, TOPIC_PLACE = ["file", "block"], ["partition"]


def parse_messages(lines: DataFrame, method: str, value: str = "value") -> DataFrame:
    """Message text -> ``kind`` with the parsed parts; other columns are kept.

    ``kind`` is ``ticks`` (a notification of the subscription ``method``, carries logs), ``catch_up_complete``, ``error``
    (RPC error response), ``unknown`` or ``malformed``; the last has its text in ``malformed_text``. Logs stay JSON text.
    """
    options = {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"}
    parsed = F.from_json(F.col(value), MESSAGE_SCHEMA + ", _bad STRING", options)
    m = F.col("__m")
    result = m["params"]["result"]
    subscribed = F.coalesce(m["method"] == method, F.lit(False))
    beyond = ~F.coalesce(result["epoch"].between(0, UINT16_MAX) & result["tick"].between(0, UINT32_MAX), F.lit(True))
    kind = (
        F.when(m.isNull() | m["_bad"].isNotNull(), F.lit("malformed"))
        .when(subscribed & beyond, F.lit("malformed"))
        .when(subscribed & F.coalesce(result["catchUpComplete"], F.lit(False)), F.lit("catch_up_complete"))
        .when(subscribed, F.lit("ticks"))
        .when(m["error"].isNotNull(), F.lit("error"))
        .otherwise(F.lit("unknown"))
    )
    return lines.withColumn("__m", parsed).select(
        *[c for c in lines.columns if c != value],
        kind.alias("kind"),
        result.alias("result"),
        m["error"].alias("error"),
        F.when(kind == "malformed", F.col(value)).alias("malformed_text"),
    )


def read_tick_stream(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None, **options) -> DataFrame:
    """Lines of message text from files, as a batch or a stream, with the ``file`` and ``block`` they stand in.

    Names of files are their order of arrival inside a batch.
    """
    if streaming:
        reader = spark.readStream.schema("value STRING").options(**options)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = spark.read.options(**options)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return reader.text(path).select("value", *place)


def read_tick_stream_topic(spark: SparkSession, servers: str, topic: str, streaming: bool = True, **options) -> DataFrame:
    """Message text from a Kafka topic, with ``partition`` and ``offset``. Needs the Kafka connector jar."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    rows = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic).options(**options).load()
    return rows.select(F.col("value").cast("string").alias("value"), "partition", "offset")


def with_place(lines: DataFrame) -> DataFrame:
    """Lines of files with ``offset``, their order inside a file block; others as they are.

    Must be computed on the scan itself, before anything moves rows.
    """
    if set(FILE_PLACE) <= set(lines.columns) and "offset" not in lines.columns:
        return lines.withColumn("offset", F.monotonically_increasing_id())
    return lines


def arrival_numbers(rows: DataFrame) -> DataFrame:
    """Add ``msg_seq``, a number of its own for every message, in order of arrival.

    A message is known by its place: partition and offset of a topic, or file, block and row of a file. Parts follow one
    another by name and number; inside a part the offset counts on. Only one row per part is looked at to
    find where its numbers begin. Rows that have ``msg_seq`` already keep it; rows without a place are left as they are.
    """
    parts = next((p for p in (FILE_PLACE, TOPIC_PLACE) if {*p, "offset"} <= set(rows.columns)), None)
    if "msg_seq" in rows.columns or parts is None:
        return rows
    spans = rows.groupBy(*parts).agg(F.min("offset").alias("__low"), F.max("offset").alias("__high"))
    before = f"sum(__high - __low + 1) over (order by {', '.join(parts)} rows between unbounded preceding and 1 preceding)"
    begins = spans.selectExpr(*parts, "__low", f"coalesce({before}, 0) __begin")
    # One row per file block or topic partition: messages are not shuffled for it.
    numbered = rows.join(F.broadcast(begins), parts).withColumn("msg_seq", F.col("__begin") + F.col("offset") - F.col("__low"))
    return numbered.drop("__begin", "__low")


def explode_logs(messages: DataFrame) -> DataFrame:
    """Messages with logs -> one row per log, with its place in the message.

    ``msg_seq`` is taken as it is, or made from the message's place (``arrival_numbers``). Without either, the order of
    messages is that of their lowest readable log id, which does not depend on file layout (log ids grow with arrival),
    but cannot tell a message from the same message sent again.
    """
    ticks = arrival_numbers(messages.filter("kind = 'ticks'"))
    if "msg_seq" not in ticks.columns:
        ids = F.transform(F.col("result.logs"), lambda x: F.when(F.get_json_object(x, "$.ok") == "true", F.get_json_object(x, "$.logId").try_cast("decimal(20,0)")))
        ticks = ticks.withColumn("__low", F.coalesce(F.array_min(ids), F.lit(0).cast("decimal(20,0)")))
        # Ids from 2^63 on continue below zero, as 64-bit numbers do.
        wrapped = F.expr("cast(case when __low < 9223372036854775808 then __low else __low - 18446744073709551616 end as bigint)")
        ticks = ticks.withColumn("msg_seq", wrapped)
    run = ["run"] if "run" in ticks.columns else []
    rows = ticks.select(
        "msg_seq",
        *run,
        F.coalesce("result.epoch", F.lit(0)).alias("message_epoch"),
        F.coalesce("result.tick", F.lit(0)).alias("message_tick"),
        F.posexplode("result.logs").alias("pos", "log_text"),
    )
    return decode_logs(rows.withColumn("pos", F.col("pos").cast("bigint")))


def decode_logs(rows: DataFrame) -> DataFrame:
    """``log_text`` -> the columns of a log, ``log_error`` and (where there is one) ``rejected_text``; other columns are kept.

    Absent and null fields have the zero value, a null log is one that is not ok. ``log_error`` names a field whose JSON type or
    range does not fit, or ``json`` for text that is no object. Such a row is ok unless it says that it is not, so that nothing
    is lost, and takes what it lacks from its message (``message_epoch``, ``message_tick``) where those columns are there.
    """
    kinds = {name: kind for name, (kind, _, _) in LOG_FIELDS.items()}
    parsed = from_json("log_text", {name: sql for name, (_, sql, _) in LOG_FIELDS.items()})
    every = {"true": list(LOG_FIELDS)}
    kept = [f"`{c}`" for c in rows.columns if c != "log_text"]
    read = rows.withColumn("__j", F.expr(parsed)).withColumn("__kinds", F.expr(suspect_kinds("log_text", "__j", kinds, every)))
    value = {name: f"__j.`{name}`" for name in LOG_FIELDS}
    value["logId"] = uint64_field("log_text", "__j", "__kinds", "logId")
    beyond = " ".join(f"when not {in_range(value[name], *bounds)} then '{name}'" for name, bounds in LOG_RANGES.items())
    error = (
        "case when log_text is null then null"
        " when not (endswith(log_text, '}') or endswith(trim(trailing ' \t\r\n' from log_text), '}')) then 'json'"
        f" else coalesce({wrong_kind('__kinds', kinds, every, 'json')}, case {beyond} end) end"
    )
    checked = read.withColumn("log_error", F.expr(fence(error)))
    own = {"epoch": "message_epoch", "tick": "message_tick"}

    def column(name: str, zero: str) -> str:
        fallback = own.get(name)
        if fallback not in rows.columns:
            fallback = zero
        within = in_range(value[name], *LOG_RANGES[name]) if name in LOG_RANGES else "true"
        rejected = f"coalesce(case when {within} then {value[name]} end, {fallback})"
        return f"case when log_error is null then coalesce({value[name]}, {zero}) else {rejected} end"

    names = {"logId": "log_id", "logDigest": "log_digest", "bodySize": "body_size", "txHash": "tx_hash"}
    return checked.selectExpr(
        *kept,
        "coalesce(__j.ok, log_error is not null) ok",
        *[f"{column(name, zero)} {names.get(name, name)}" for name, (_, _, zero) in LOG_FIELDS.items() if zero],
        "case when contains(__kinds, ', body: VOID') then 'null' else __j.body end body",
        "log_error",
        "case when log_error is not null then log_text end rejected_text",
    )


def read_rpc_logs(spark: SparkSession, path: str) -> DataFrame:
    """Files with one RPC response each, ``{"result":[log, ...]}`` -> one row per log, by place."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.from_json("value", "result ARRAY<STRING>").alias("response")
    )
    rows = files.select("file", F.posexplode("response.result").alias("pos", "log_text"))
    return decode_logs(rows.withColumn("pos", F.col("pos").cast("bigint")))
