"""Topic rows to Kafka or NDJSON, and bulk files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.operators.documents import bulk_ndjson
from tickflow.operators.messages import message_json


#: Rows of a tick that stay together.
TICK_ROWS = 1 << 17


def in_topic_order(topic_rows: DataFrame, tick_rows: int = TICK_ROWS) -> DataFrame:
    """Rows in (tick, index) order over the partitions, a tick in one of them.

    Ranges are cut between ticks, by the sizes that sampling finds. Only a tick of more than ``tick_rows`` rows, which its indices
    tell, may be cut, after every so many; its rows carry their index.
    """
    piece = F.floor(F.col("index") / tick_rows)
    return topic_rows.repartitionByRange("tick", piece).sortWithinPartitions("tick", "index")


def publish_kafka(topic_rows: DataFrame, servers: str, topic: str, **options) -> None:
    """Keyed by tick, acknowledged by all in-sync replicas, lz4. Needs the Kafka connector jar."""
    (
        in_topic_order(topic_rows)
        .select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.compression.type", "lz4")
        .option("topic", topic)
        .options(**options)
        .save()
    )


def publish_ndjson(topic_rows: DataFrame, path: str) -> None:
    """The same values as text files; writing the same batch again replaces it."""
    in_topic_order(topic_rows).select("value").write.mode("overwrite").text(path)


def write_event_ndjson(messages: DataFrame, path: str) -> None:
    """One event JSON per line."""
    messages.selectExpr(f"{message_json()} value").write.mode("overwrite").text(path)


def write_bulk_ndjson(documents: DataFrame, path: str, index: str) -> None:
    """Bulk file: an action line and a document line per document, kept together in one record."""
    bulk_ndjson(documents, index).write.mode("overwrite").text(path)
