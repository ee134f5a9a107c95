"""Tables that jobs keep and that may see a batch twice.

* Events and documents are run tables (``runs.py``): a batch adds a run, runs are merged as they pile up, and a list that is
  switched last says what counts.
* Errors lie under ``batch=<id>``; a batch that runs again replaces its folder, also by an empty one.
* Small state lives in two slots: batch b reads slot (b - 1) % 2 and writes slot b % 2, so a rerun starts from the
  state it started from before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickflow.operators.documents import route_records
from tickflow.operators.events import EVENT_KEY
from tickflow.schemas import DOCUMENT_COLUMNS, STORED_SCHEMA
from tickflow.sinks.runs import RunTable

PROGRESS_SCHEMA = (
    "epoch BIGINT, last_log_id DECIMAL(20,0), last_tick BIGINT, next_index BIGINT, section_open BOOLEAN, batch BIGINT"
)
HEIGHT_SCHEMA = "tick DECIMAL(20,0), processed BIGINT, batch BIGINT"
COUNTER_SCHEMA = "tick DECIMAL(20,0), processed BIGINT, skipped BIGINT, total DECIMAL(20,0), batch BIGINT"


def write_batch(rows: DataFrame, path: str, batch: int) -> None:
    """Rows of one batch in a folder of their own."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def events_table(spark: SparkSession, path: str) -> RunTable:
    """Stored events."""
    return RunTable(spark, path, STORED_SCHEMA, tuple(EVENT_KEY), lookup="log_id", span="log_id")


def read_events(spark: SparkSession, path: str, epoch: int | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
    """Stored events, the newest row per key; of an epoch and tick range only the runs that can hold it are opened."""
    return events_table(spark, path).read(epoch, first, last)


def compact_events(spark: SparkSession, path: str, out: str) -> None:
    """A copy of the table in one run, which holds every key once."""
    events_table(spark, out).append(read_events(spark, path), 0, "index_in_tick")


def documents_table(spark: SparkSession, path: str) -> RunTable:
    """Documents by ``doc_id``."""
    empty = route_records(spark.createDataFrame([], "value string"))
    schema = empty.selectExpr("'' doc_id", *[f"`{c}`" for c in DOCUMENT_COLUMNS]).schema
    return RunTable(spark, path, schema, ("doc_id",), tick="tickNumber", lookup="doc_id", span="logId")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """All documents, the newest per id; none if no batch wrote one."""
    return documents_table(spark, path).read()


def _read(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The table, or an empty frame if it was never written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_state(spark: SparkSession, path: str, batch: int, schema: str) -> DataFrame:
    """State as it was after ``batch``; empty before the first one."""
    if batch < 0:
        return spark.createDataFrame([], schema)
    return _read(spark, f"{path}/slot={batch % 2}", schema).filter(F.col("batch") == batch)


def write_state(rows: DataFrame, path: str, batch: int) -> None:
    rows.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(f"{path}/slot={batch % 2}")


def newest_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """State of the newest batch."""
    both = _read(spark, path, schema)
    return both.filter(F.col("batch") == both.agg(F.max("batch").alias("batch")).scalar())


def save_progress(row: DataFrame, path: str, batch: int) -> None:
    """Epoch, last log id, last tick and what the next batch continues from: one row, one commit."""
    write_state(row, path, batch)
