"""Document fingerprints by locally consistent parsing.

Runs of equal symbols become one symbol. Deterministic coin tossing then labels
each symbol by the lowest bit in which it differs from the one before; three
rounds leave labels of a few values, in which no two neighbours are equal. Phrases
begin at local maxima of the labels, so where they begin depends on some neighbours
only, and equal substrings get equal phrases but for a few at their ends, at any offset.
A phrase's name is a hash of its symbols; names are the symbols of the next level.

A fingerprint is the ``KEPT`` smallest of the names of the levels ``LEVELS`` (about
9, 27 and 81 characters), as hex. Likeness of two fingerprints is the share of
common names among the smallest names of both, an estimate of the shared text.

``with_next`` pairs each row with the next one by ascending doc_id (the last with
the first). Rows are dealt to blocks of consecutive ids; the first row of a block
also goes to the block before it. Texts are shuffled once.

Null texts read as empty ones. Empty fingerprints are like each other (1) and
unlike any other (0). Rows with equal ids are ordered by text; rows without id come first.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import mix

LEVELS, KEPT = (2, 3, 4), 64
_PIECE = 1 << 18


def _lowest_bit(x: np.ndarray) -> np.ndarray:
    low = x & (~x + np.uint64(1))
    return (low.astype(np.float64).view(np.int64) >> 52) - 1023


def phrases(symbols: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: (names, doc) of the phrases of ``symbols``; ``doc`` is ascending, phrases stay inside a document."""
    new = np.ones(len(symbols), bool)
    new[1:] = (symbols[1:] != symbols[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    length = np.diff(at, append=len(symbols))
    symbols, doc = symbols[at], doc[at]
    long = length > 1
    symbols[long] = mix(symbols[long] + length[long].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    first = np.ones(len(symbols), bool)
    first[1:] = doc[1:] != doc[:-1]
    label = symbols
    for _ in range(3):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        before[first] = ~label[first]
        bit = _lowest_bit(label ^ before).astype(np.uint64)
        label = bit * np.uint64(2) + ((label >> bit) & np.uint64(1))
    label = label.astype(np.int8)
    peak = first.copy()
    if len(label) > 2:
        peak[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:]) & ~first[2:]
    starts = np.flatnonzero(peak)
    place = np.arange(len(symbols)) - np.repeat(starts, np.diff(starts, append=len(symbols)))
    return np.add.reduceat(mix(symbols + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), starts), doc[starts]


def _smallest(keys: list[np.ndarray], docs: int) -> list[np.ndarray]:
    """The smallest distinct names (32 bits) of each document, from keys that hold document and name."""
    every = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.uint64)
    ends = np.searchsorted(every, np.arange(docs + 1, dtype=np.uint64) << np.uint64(32))
    return [every[a : min(b, a + KEPT)].astype(np.uint32) for a, b in zip(ends, ends[1:])]


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """Fingerprints of texts, worked on together."""
    lengths = [len(t) for t in texts]
    symbols = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64) + np.uint64(1)
    doc = np.repeat(np.arange(len(texts)), lengths)
    keys = []
    for level in range(1, LEVELS[-1] + 1):
        if not len(symbols):
            break
        symbols, doc = phrases(symbols, doc)
        if level in LEVELS:
            names = mix(symbols + np.uint64(level))
            keys.append((doc.astype(np.uint64) << np.uint64(32)) | (names >> np.uint64(32)))
    return _smallest(keys, len(texts))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    # Names are distinct in each, so a name that stands twice is common.
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    common = both[1:][twice]
    union = np.concatenate([both[:1], both[1:][~twice]])[: KEPT]
    return float(np.searchsorted(common, union[-1], "right") / len(union))


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def edited(text: str, after: str) -> str:
    """The last quarter replaced by as much of the beginning of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


def with_next(docs: DataFrame, rows: int = 1024, most: int = 1 << 16) -> DataFrame:
    """(doc_id, text) -> (block, beyond, doc_id, text): blocks of consecutive rows by id and then by the hash of the text, sorted,
    each closed by a row ``beyond`` it, the first of the next block.

    A block has about ``rows`` rows while that gives a few blocks for each shuffle partition, and ``most`` beyond; what
    works on it takes its rows as a stream. The driver sees where each block begins, two numbers for some ``most`` rows.
    Rows equal in id and text lie in one block.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("mark", F.xxhash64("text"))
    keys = texts.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "mark")
    n = keys.count()
    wanted = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = keys.repartitionByRange(max(1, -(-n // most), min(-(-n // rows), wanted)), "id", "mark")
    firsts = parts.groupBy(F.spark_partition_id()).agg(F.min(F.struct("id", "mark")).alias("first")).select("first.*").toArrow()
    ids, marks = firsts.column("id").to_numpy(), firsts.column("mark").to_numpy()
    order = np.lexsort((marks, ids))
    sent = docs.sparkSession.sparkContext.broadcast((ids[order], marks[order]))

    @F.arrow_udf("array<struct<block: int, beyond: boolean>>")
    def blocks(values: pa.Array, marks: pa.Array) -> pa.Array:
        ids, firsts = sent.value
        at, mark = values.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), marks.to_numpy()
        low, high = np.searchsorted(ids, at, "left"), np.searchsorted(ids, at, "right")
        out = []
        for value, own, a, b in zip(at.tolist(), mark.tolist(), low.tolist(), high.tolist()):
            # Of the blocks that begin with this id, the last one whose first text does not come later.
            b = max(a + int(np.searchsorted(firsts[a:b], own, "right")) if a < b else b, 1) - 1
            here = [{"block": b, "beyond": False}]
            out.append(here + [{"block": (b - 1) % len(ids), "beyond": True}] if value == ids[b] and own == firsts[b] else here)
        return pa.array(out, pa.list_(pa.struct([("block", pa.int32()), ("beyond", pa.bool_())])))

    if not len(ids):
        return texts.select(F.lit(0).alias("block"), F.lit(False).alias("beyond"), "doc_id", "text")
    dealt = texts.withColumn("at", F.explode(blocks("doc_id", "mark"))).select("at.block", "at.beyond", "doc_id", "mark", "text")
    dealt = dealt.repartition("block").sortWithinPartitions("block", "beyond", F.col("doc_id").asc_nulls_first(), "mark", "text")
    return dealt.drop("mark")


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _work(pairs: list[tuple[int, str, str]]) -> pa.RecordBatch:
    texts = [t for _, t, _ in pairs]
    changed = [edited(t, after) for _, t, after in pairs]
    prints = fingerprints([*texts, *changed, pairs[-1][2]])
    own, other, after = prints[: len(texts)], prints[len(texts) : -1], prints[1 : len(texts)] + prints[-1:]
    columns = [
        pa.array([i for i, _, _ in pairs], pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed]),
        pa.array([as_text(f) for f in own]),
        pa.array([as_text(f) for f in other]),
        pa.array([likeness(a, b) for a, b in zip(own, other)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCHEMA.split(", ")])


def _blocks(batches):
    before, pairs, size = None, [], 0
    for batch in batches:
        for block, beyond, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("block", "beyond", "doc_id", "text"))):
            if before is not None:
                pairs.append((before[0], before[1], text))
                size += len(before[1])
                if size >= _PIECE or beyond:
                    yield _work(pairs)
                    pairs, size = [], 0
                before = None
            if not beyond:
                before = (doc_id, text)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, digest of the edited text, both fingerprints, and likeness to the edited and to the next text."""
    return with_next(docs).mapInArrow(_blocks, _SCHEMA)
