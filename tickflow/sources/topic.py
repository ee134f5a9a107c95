"""Topic records: Kafka, or NDJSON files with the same value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_event_topic(
    spark: SparkSession, servers: str, topic: str, max_records: int | None = None, **options
) -> DataFrame:
    """A bounded stream of topic records. Needs the Kafka connector jar."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    rows = reader.options(**options).load()
    return rows.select(F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset")


def read_event_ndjson(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """One event JSON per line; blank lines are left out."""
    if streaming:
        reader = spark.readStream.schema("value STRING")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        lines = reader.text(path)
    else:
        lines = spark.read.text(path)
    return lines.select(F.btrim("value", F.lit(" \t\r\n")).alias("value")).filter("value <> ''")
