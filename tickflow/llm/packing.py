"""Best-fit packing: pieces of encoded documents into sequences of at most ``capacity`` ids.

Bounded-space online best fit: a task has at most ``open_bins`` open bins, kept by their free space,
with one bit for every free space that some bin has. A piece goes to the bin with the least
space that suffices, which is the lowest bit from its length on. If none does, a new bin opens, and where
that is one too many, the fullest closes. A full bin closes at once.

What a task has open in the end is not yet a sequence: the pieces of its ``open_bins`` emptiest bins go to
the next level, where ``fan_in`` tasks' leftovers meet in one, longest first, and so on until one task is left.
There, a task has ``open_bins`` bins for each task it takes over from. So what it holds is bounded whatever the size
of the table, and only those pieces are shuffled; ids of tokens are not needed to place a piece.

Documents are cut only if they are longer than a sequence. A null or empty text has no ids but the one that
ends every document. Repeated rows and rows without an id are packed like all others; an empty table gives
no sequences. Columns other than ``doc_id`` and ``text`` are not looked at. Each level is written to the
shared folder, so that a lost executor's tasks run again over the same rows.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.bpe import byte_alphabet
from tickflow.llm.common import runs, small_arrow_batches, small_batches, written
from tickflow.llm.stretches import StretchIds, text_batches

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_OUT_ROWS = 4096


class LibraryIds(StretchIds):
    """Ids by the tokenizers library.

    Of plain stretches the words are found here and go to the library's model, which is all that the file's other steps
    leave to do for them; any other stretch goes through the whole of the library.
    """

    def __init__(self, spec: str, remembered: int = 50_000):
        super().__init__(remembered)
        # A task has one core; the library would start a thread, with memory of its own, for every core of the machine.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        # The letters that stand for bytes.
        self.letters = {byte: letter for byte, letter in enumerate(byte_alphabet()) if chr(byte) != letter}

    def new(self, chunks: list[str]) -> list[bytes]:
        known, tokenize, letters = self.known, self.model.tokenize, self.letters
        out, odd = [], []

        def ids(word: str) -> bytes:
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(letters)
            return array("I", [t.id for t in tokenize(word)]).tobytes()

        for chunk in chunks:
            words = self.words_of(chunk)
            if words is None:
                odd.append(len(out))
                out.append(b"")
            elif len(words) == 1:
                out.append(ids(words[0]))
            else:
                # A word is a stretch too, so it may be known.
                out.append(b"".join([known.get(word) or ids(word) for word in words]))
        for start in range(0, len(odd), 1024):
            some = odd[start : start + 1024]
            asked = [chunks[i] for i in some]
            for i, found in zip(some, self.tokenizer.encode_batch_fast(asked, add_special_tokens=False)):
                out[i] = array("I", found.ids).tobytes()
        return out


_LOADED: dict[int, LibraryIds] = {}


def _library(spec: str) -> LibraryIds:
    """One for a Python worker, which runs many tasks."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = LibraryIds(spec)
    return _LOADED[key]


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, with_ids: bool = False) -> DataFrame:
    """(doc_id, text) -> the pieces of every row: doc_id, piece, start, length, ids_crc32, and ``ids`` where wanted.

    A row's ids are those of the vocabulary file at ``path`` (read on the driver, broadcast) and then ``end``.
    """
    small_arrow_batches(docs.sparkSession)
    with open(path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    last = np.array([end], np.uint32)

    def cut(batches):
        library = _library(spec.value)
        for batch in text_batches(batches):
            ids, begins = library.encode(batch.column("text"))
            rows = []
            for doc, begin, stop in zip(batch.column("doc_id").to_pylist(), begins, begins[1:]):
                n = int(stop - begin) + 1
                for piece, at in enumerate(range(0, n, capacity)):
                    part = ids[begin + at : min(begin + at + capacity, stop)]
                    if len(part) < capacity:
                        part = np.concatenate([part, last])
                    rows.append((doc, piece, at, len(part), zlib.crc32(part), *([part.view(np.int32)] if with_ids else [])))
            yield _batch(rows, _arrow(with_ids))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(cut, PIECE + (", ids array<int>" if with_ids else ""))


def _arrow(with_ids: bool, placed: bool = False) -> pa.Schema:
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.list_(pa.int32()))] if with_ids else []
    fields += [("sequence_id", pa.int64()), ("offset", pa.int64()), ("task", pa.int64())] if placed else []
    return pa.schema(fields)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class Bins:
    """Open bins by free space. ``put`` takes a piece shorter than a bin and returns the bin that closed, as its rows, or None."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.free = 0  # bit f: there is a bin with f free
        self.n = 0

    def put(self, length: int, row) -> list | None:
        fitting = self.free >> length
        closed = None
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            rows = self._take(free)
        else:
            if self.n == self.open_bins:
                closed = self._take((self.free & -self.free).bit_length() - 1)
            free, rows = self.capacity, []
        rows.append(row)
        if free == length:
            return rows
        self.by_free[free - length].append(rows)
        self.free |= 1 << (free - length)
        self.n += 1
        return closed

    def _take(self, free: int) -> list:
        rows = self.by_free[free].pop()
        if not self.by_free[free]:
            self.free ^= 1 << free
        self.n -= 1
        return rows

    def rest(self) -> Iterator[list]:
        """The bins still open, the fullest first."""
        for bins in self.by_free:
            yield from bins


def _packer(capacity: int, open_bins: int, fan_in: int, level: int, last: bool, schema: pa.Schema):
    """A task's rows -> the same with sequence_id and offset, or with ``task`` where they go to the next level."""

    def fill(task: int, rows: Iterable[tuple]) -> Iterator[tuple]:
        length_at = schema.get_field_index("length")
        bins = Bins(capacity, open_bins * fan_in if level else open_bins)
        name = (level << 57) | (task << 32)

        def placed(rows: list) -> Iterator[tuple]:
            nonlocal name
            offset = 0
            for row in rows:
                yield *row, name, offset, None
                offset += row[length_at]
            name += 1

        for row in rows:
            if row[length_at] == capacity:
                yield from placed([row])
            elif closed := bins.put(row[length_at], row):
                yield from placed(closed)
        final = bins.n if last else max(0, bins.n - open_bins)
        for i, rest in enumerate(bins.rest()):
            yield from placed(rest) if i < final else ((*row, None, None, task) for row in rest)

    def out(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in rows:
            held.append(row)
            if len(held) == _OUT_ROWS:
                yield _batch(held, schema)
                held = []
        yield _batch(held, schema)

    names = schema.names[:-3]
    as_rows = lambda table: zip(*(table.column(c).to_pylist() for c in names))

    def first(batches):
        # The partition of a scan of written files is the same whenever it runs again.
        yield from out(fill(TaskContext.get().partitionId(), (row for batch in small_batches(batches, _OUT_ROWS) for row in as_rows(batch))))

    def later(batches):
        for group in runs(batches, ["task"]):
            yield from out(fill(group.column("task")[0].as_py(), as_rows(group)))

    return later if level else first


def pack(rows: DataFrame, capacity: int = 2048, open_bins: int = 512, fan_in: int = 64) -> DataFrame:
    """Rows of ``pieces`` -> the same with ``sequence_id`` and ``offset``, the place of the piece in its sequence."""
    with_ids = "ids" in rows.columns
    columns = _arrow(with_ids).names
    schema = _arrow(with_ids, placed=True)
    types = PIECE + (", ids array<int>" if with_ids else "") + ", sequence_id long, offset long, task long"
    rows = written(rows.select(*columns), "pieces")
    tasks = rows.rdd.getNumPartitions()
    done, level = [], 0
    while True:
        packed = written(rows.mapInArrow(_packer(capacity, open_bins, fan_in, level, tasks <= 1, schema), types), "packed")
        done.append(packed.filter("sequence_id is not null").drop("task"))
        if tasks <= 1:
            break
        tasks, level = -(-tasks // fan_in), level + 1
        rows = packed.filter("sequence_id is null").selectExpr(*columns, f"task div {fan_in} as task")
        rows = rows.repartition("task").sortWithinPartitions("task", F.desc("length"), "doc_id", "piece")
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def packed_sequences(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, **options) -> DataFrame:
    """The sequences themselves: sequence_id, ``ids`` (at most ``capacity``), and ``documents``, what lies where in them."""
    placed = pack(pieces(docs, path, capacity, end, with_ids=True), capacity, **options)
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids")))
    whole = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    documents = F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["start"].alias("start"), p["offset"].alias("offset"), p["length"].alias("length")))
    return whole.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), documents.alias("documents"))


def fill(placed: DataFrame, capacity: int = 2048) -> DataFrame:
    """How well a packing fills: its number of sequences, and the least number that its ids need."""
    return placed.agg(F.count_distinct("sequence_id").alias("sequences"), F.ceil(F.sum("length") / capacity).alias("least"))
