"""Event messages for the topic, stored events, and the rows a topic takes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickflow.operators.bodies import rename_body, rename_stored_body, source_body_json
from tickflow.schemas import REJECTED_TYPE, STORED_COLUMNS

_ENVELOPE = [
    "index",
    "type",
    "tickNumber",
    "epoch",
    "logDigest",
    "logId",
    "bodySize",
    "timestamp",
    "transactionHash",
]


def build_event_message(enriched: DataFrame) -> DataFrame:
    """Enriched, parsed log rows -> the 12 message columns; ``body`` is JSON text or NULL."""
    return enriched.selectExpr(
        "index_in_tick `index`",
        "coalesce(type, 0) type",
        "tick tickNumber",
        "epoch",
        "coalesce(log_digest, '') logDigest",
        "log_id logId",
        "coalesce(body_size, 0) bodySize",
        "coalesce(timestamp, 0) timestamp",
        "coalesce(tx_hash, '') transactionHash",
        f"{rename_body()} body",
        "dividend",
        "last_log_for_tick lastLogForTick",
    )


def replay_messages(stored: DataFrame) -> DataFrame:
    """Stored events -> message columns plus ``rename_error``; body size and dividend are not stored."""
    return rename_stored_body(stored).selectExpr(
        "index_in_tick `index`",
        "event_type type",
        "tick tickNumber",
        "epoch",
        "log_digest logDigest",
        "log_id logId",
        "0L bodySize",
        "timestamp",
        "tx_hash transactionHash",
        "topic_body body",
        "false dividend",
        "last_log_for_tick lastLogForTick",
        "rename_error",
    )


def message_json() -> str:
    """One event as JSON. The two flags appear only when they are true."""
    envelope = f"to_json(struct({', '.join(f'`{c}`' for c in _ENVELOPE)}))"
    return f"""concat(rtrim('}}', {envelope}), ',"body":', coalesce(body, 'null'),
        case when dividend then ',"dividend":true' else '' end,
        case when lastLogForTick then ',"lastLogForTick":true' else '' end, '}}')"""


def to_topic_rows(messages: DataFrame) -> DataFrame:
    """``key`` (tick as text: one tick, one topic partition), ``value`` (JSON), and the sort columns."""
    return messages.selectExpr(
        "cast(tickNumber as string) key",
        f"{message_json()} value",
        "epoch",
        "tickNumber tick",
        "`index`",
        "logId log_id",
        "type",
    )


def rejection_rows(rejected: DataFrame) -> DataFrame:
    """Enriched rows with ``reason`` -> topic rows that stand for them, without a body.

    They keep the place of the log in its tick, so that the tick is known to be complete; ``rejected`` and ``rejectedType`` say
    what became of it. Fields that a record must not lack are filled in.
    """
    envelope = {
        "index": "index_in_tick",
        "type": f"{REJECTED_TYPE}L",
        "tickNumber": "tick",
        "epoch": "epoch",
        "logDigest": "coalesce(nullif(log_digest, ''), 'none')",
        "logId": "log_id",
        "bodySize": "0L",
        "timestamp": "greatest(timestamp, 1)",
        "transactionHash": "''",
        "rejected": "reason",
        "rejectedType": "type",
    }
    members = ", ".join(f"{value} as `{name}`" for name, value in envelope.items())
    flag = """case when last_log_for_tick then ',"lastLogForTick":true' else '' end"""
    return rejected.selectExpr(
        "cast(tick as string) key",
        f"""concat(rtrim('}}', to_json(struct({members}))), ',"body":null', {flag}, '}}') value""",
        "epoch",
        "tick",
        "index_in_tick `index`",
        "log_id",
        f"{REJECTED_TYPE}L type",
    )


def to_stored_event(enriched: DataFrame, *arrival: str) -> DataFrame:
    """Enriched, parsed log rows -> the stored columns (and ``arrival``); the body keeps its source keys."""
    columns = {
        "log_id": "cast(log_id as decimal(20,0))",
        "event_type": "coalesce(type, 0)",
        "tx_hash": "coalesce(tx_hash, '')",
        "timestamp": "coalesce(timestamp, 0)",
        "body": source_body_json(),
        "log_digest": "coalesce(log_digest, '')",
    }
    return enriched.selectExpr(*[f"{columns.get(c, c)} {c}" for c in STORED_COLUMNS], *arrival)
