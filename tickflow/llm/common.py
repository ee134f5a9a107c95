"""What the operators of this folder share: tables in the shared folder, hashes, streams of groups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every contract here: space and the five controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset, a folder of our own, on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    base = tempfile.mkdtemp(prefix="tickflow-llm-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: its lineage ends there, and lost executors cost nothing."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_arrow_batches(spark: SparkSession) -> None:
    """Rows go to Python at most 1,024 and about 8 MB at a time from here on in this session: texts may be long, and the JVM holds a
    batch several times beside its heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def held_out(doc_id: Column) -> Column:
    """Whether a row's labels are kept from training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def in_fold(doc_id: Column) -> Column:
    """Whether labels of a row may be learned from; not without an id."""
    return doc_id.isNotNull() & ~held_out(doc_id)


def hash64(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordIds(dict):
    """64-bit ids of words, remembered for up to ``limit`` words at a time."""

    def __init__(self, limit: int = 300_000):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = hash64(word)
        return value


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that what a step holds beside them stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal keys, from a partition sorted by them, across batch borders."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for key in keys:
            column = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            change[1:] |= column[1:] != column[:-1]
            if held:
                last = held[-1].column(batch.schema.get_field_index(key))
                change[0] |= last[len(last) - 1].as_py() != column[0]
        start = 0
        for cut in np.flatnonzero(change):
            if cut > start:
                held.append(batch.slice(start, cut - start))
            if held:
                yield pa.Table.from_batches(held)
            held, start = [], int(cut)
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
