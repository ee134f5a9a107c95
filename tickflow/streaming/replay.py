"""Replay: stored events of one epoch and tick range -> topic rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.operators.events import in_range
from tickflow.operators.messages import replay_messages, to_topic_rows
from tickflow.operators.validate import BadRecords
from tickflow.streaming.bridge import Publisher


def run_replay(events: DataFrame, publish: Publisher, epoch: int, start: int = 0, end: int = 0) -> DataFrame:
    """Publish ``start <= tick <= end`` of an epoch (0 leaves a side open); returns the message frame.

    An event that cannot be renamed stops the replay before anything is published.
    """
    messages = replay_messages(events.filter((F.col("epoch") == epoch) & in_range(start, end)))
    bad = messages.filter("rename_error is not null").select("type", "rename_error").take(1)
    if bad:
        raise BadRecords(f"{bad[0]['rename_error']}: {bad[0]['type']}")
    publish(to_topic_rows(messages), 0)
    return messages
