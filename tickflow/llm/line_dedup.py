"""Line dedup by a tree of log templates.

A line's tokens are its words. Words with a digit are variable fields and read as
``<*>``, if at least half of the tokens, and two, are constant; other lines
(rows of numbers) are known by their words as they are. The tree has a fixed depth: the
number of tokens, then the leading tokens. In a leaf the lines are taken by digest: a
line joins the first head with enough equal tokens at equal places, else it is a
head itself. Lines of which joining could leave too few constant tokens join none.

A template (a head's lines) recurs if its lines occur in several documents (short lines
need more of them: a line of one word and one of seven by the same rule). Of a
recurring template the first line (by doc_id, then place) stays where it is and all
others are dropped.

What is shuffled is one row of numbers per distinct line of a document, combined before the
shuffle; and, for distinct lines that share a leaf with another, once the
64-bit hashes of their tokens. A leaf with more than ``leaf_lines`` distinct lines is
worked on in cells: two alike lines differ in k places at most, so of k + 1 pieces of
the places in which any lines of the leaf differ they have one in common. Each piece is a cell, and cells that are still too large
are cut again by the places in which their lines differ, until they are small or their lines differ in k
places altogether. The heads are the same as without cells, and no task holds more
than ``leaf_lines`` lines of a leaf.

Null texts have no lines and stay null; a text of which every line goes becomes
empty; no row is removed. Rows without an id are left as they are. Rows that
share an id count as one document. Repeated lines of one document count once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import WordIds, hash64, runs, small_batches, written

_FIELD = re.compile(rb"(?<![^\x20\x09-\x0d])[^\x20\x09-\x0d0-9]*[0-9][^\x20\x09-\x0d]*")
_VARIABLE = b"<*>"


def _read(raw: bytes, masked: bytes) -> tuple[list[bytes], int]:
    """Tokens of a line, and how many of them are constant."""
    tokens = masked.split()
    constant = len(tokens) - tokens.count(_VARIABLE)
    if constant < len(tokens) and (constant < 2 or 2 * constant < len(tokens)):
        return raw.split(), constant
    return tokens, constant


def _split_lines(text: str) -> tuple[list[bytes], list[bytes]]:
    """Lines as they are, and with their variable fields masked."""
    data = text.encode("utf-8", "replace")
    raw = data.split(b"\n")
    return raw, (_FIELD.sub(_VARIABLE, data).split(b"\n") if re.search(rb"[0-9]", data) else raw)


def _parsed(text: str, least: int) -> Iterator[tuple[int, int, list[bytes], int]]:
    """(line number, digest of the line, tokens, constant tokens) of the lines that have at least ``least`` tokens."""
    for number, (raw, masked) in enumerate(zip(*_split_lines(text))):
        tokens, constant = _read(raw, masked)
        if tokens and len(tokens) >= least:
            yield number, hash64(b" ".join(tokens)), tokens, constant


def _leaf(tokens: list[bytes], leading: int) -> int:
    return hash64(b"%d %s" % (len(tokens), b" ".join(tokens[:leading])))


def lines_of(text: str, leading: int, least: int) -> Iterator[tuple[int, int, int, list[bytes]]]:
    """(line number, leaf, digest of the line, tokens) of the lines that have at least ``least`` tokens."""
    for number, line, tokens, _ in _parsed(text, least):
        yield number, _leaf(tokens, leading), line, tokens


def _slack(n_tokens: int, likeness: float) -> int:
    """In how many places alike lines may differ."""
    return int(n_tokens * (1 - likeness) + 1e-9)


def _as_long(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _scan(leading: int, likeness: float, least: int):
    """Distinct lines of each document; without a leaf if a line can join no other."""

    def scan(batches):
        for batch in small_batches(batches):
            ids, places, leaves, lines, sizes = [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                seen = set()
                for number, line, tokens, constant in _parsed(text or "", least):
                    if line not in seen:
                        seen.add(line)
                        slack = _slack(len(tokens), likeness)
                        joins = slack and constant - slack >= 2 and 2 * (constant - slack) >= len(tokens)
                        ids.append(doc_id)
                        places.append(number)
                        leaves.append(_leaf(tokens, leading) if joins else None)
                        lines.append(line)
                        sizes.append(len(tokens))
            leaf = pa.array([None if x is None else x - (x >> 63 << 64) for x in leaves], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(places, pa.int32()), leaf, _as_long(lines), pa.array(sizes, pa.int32())],
                ["doc_id", "place", "leaf", "line", "n_tokens"],
            )

    return scan


def _fetch(batches):
    """Token hashes of the wanted lines; of texts that share an id, from those that have the line there."""
    ids = WordIds()
    for batch in small_batches(batches):
        leaves, lines, tokens = [], [], []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            raw, masked = _split_lines(text)
            for w in wanted:
                if w["place"] < len(raw):
                    words, _ = _read(raw[w["place"]], masked[w["place"]])
                    if hash64(b" ".join(words)) == w["line"] & 0xFFFFFFFFFFFFFFFF:
                        leaves.append(w["leaf"])
                        lines.append(w["line"])
                        tokens.append(np.array([ids[x] for x in words], np.uint64).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), pa.array(lines, pa.int64()), pa.array(tokens, pa.binary())], ["leaf", "line", "tokens"])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint64).reshape(len(rows), -1)


def grow(tokens: np.ndarray, slack: int) -> np.ndarray:
    """The head (number of its row) of each of a leaf's lines, in the order given."""
    heads = np.empty_like(tokens)
    first: list[int] = []
    out = np.arange(len(tokens))
    for i, row in enumerate(tokens):
        alike = (heads[: len(first)] != row).sum(axis=1) <= slack
        if alike.any():
            out[i] = first[int(alike.argmax())]
        else:
            heads[len(first)] = row
            first.append(i)
    return out


def _grow_leaves(likeness: float):
    """Lines that join a head, with it; from partitions sorted by leaf and line."""

    def work(batches):
        for leaf in runs(batches, ["leaf"]):
            if leaf.num_rows > 1:
                tokens, line = _matrix(leaf.column("tokens")), leaf.column("line").to_numpy()
                head = grow(tokens, _slack(tokens.shape[1], likeness))
                joins = np.flatnonzero(head != np.arange(len(head)))
                yield pa.RecordBatch.from_arrays([pa.array(line[joins]), pa.array(line[head[joins]])], ["line", "head"])

    return work


def _differ(batches):
    """How many lines of a cell differ from its centre at each place, and in how many places alike lines may differ."""
    for batch in small_batches(batches):
        counts: dict[int, np.ndarray] = {}
        for cell, tokens, centre in zip(*(batch.column(c).to_pylist() for c in ("cell", "tokens", "centre"))):
            differs = np.frombuffer(tokens, np.uint64) != np.frombuffer(centre, np.uint64)
            counts[cell] = counts[cell] + differs if cell in counts else differs.astype(np.int64)
        cells, places, lines = [], [], []
        for cell, n in counts.items():
            at = np.flatnonzero(n)
            cells += [cell] * len(at)
            places += at.tolist()
            lines += n[at].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(places, pa.int32()), pa.array(lines, pa.int64())], ["cell", "place", "n"])


def _cut(likeness: float):
    """Each line in the cells of the pieces of the places in which its cell's lines differ.

    Places that all lines of a cell have alike separate nothing and are left out. Those in which most lines differ go to
    different pieces.
    """

    def work(batches):
        for batch in small_batches(batches, 128):
            cells, lines, rows, marks = [], [], [], []
            for leaf, line, row, fixed, differ in zip(*(batch.column(c).to_pylist() for c in ("leaf", "line", "tokens", "fixed", "differ"))):
                tokens = np.frombuffer(row, np.uint64)
                mark = np.zeros(len(tokens), bool) if fixed is None else np.frombuffer(fixed, bool)
                pieces = _slack(len(tokens), likeness) + 1
                # More places differ than alike lines may differ in, so no piece is empty.
                for k in range(pieces):
                    inner = mark.copy()
                    inner[differ[k::pieces]] = True
                    cells.append(hash64(b"%d %s %s" % (leaf, inner.tobytes(), tokens[inner].tobytes())))
                    lines.append((leaf, line))
                    rows.append(row)
                    marks.append(inner.tobytes())
            leaf, line = zip(*lines) if lines else ((), ())
            yield pa.RecordBatch.from_arrays(
                [_as_long(cells), pa.array(leaf, pa.int64()), pa.array(line, pa.int64()), pa.array(rows, pa.binary()), pa.array(marks, pa.binary())],
                ["cell", "leaf", "line", "tokens", "fixed"],
            )

    return work


def _lowest(likeness: float):
    """The first alike line before each open line of a cell, and whether that is a head."""

    def work(batches):
        for cell in runs(batches, ["cell"]):
            tokens, line, is_head = _matrix(cell.column("tokens")), cell.column("line").to_numpy(), cell.column("is_head").to_numpy()
            slack = _slack(tokens.shape[1], likeness)
            at, low = [], []
            for i in np.flatnonzero(~is_head):
                alike = (tokens[:i] != tokens[i]).sum(axis=1) <= slack
                if alike.any():
                    at.append(i)
                    low.append(int(alike.argmax()))
            at, low = np.array(at, np.int64), np.array(low, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(line[at]), pa.array(line[low]), pa.array(is_head[low])], ["line", "low", "is_head"])

    return work


def _grow_large(rows: DataFrame, likeness: float, leaf_lines: int) -> DataFrame:
    """As ``_grow_leaves``, for leaves (leaf, line, tokens) that no task should hold."""
    cells = rows.selectExpr("leaf as cell", "leaf", "line", "tokens", "cast(null as binary) as fixed")
    small, alike = [], []
    while True:
        cells = written(cells, "cells")
        sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("line", "tokens")).alias("first"))
        # Each of these stands ``leaf_lines`` times.
        sizes = written(sizes.filter(F.col("n") > leaf_lines).selectExpr("cell", "first.tokens as centre"), "large-cells")
        small.append(cells.join(sizes.select("cell"), "cell", "left_anti").select("cell", "line", "tokens"))
        if sizes.isEmpty():
            break
        large = cells.join(sizes, "cell")
        differ = large.select("cell", "tokens", "centre").mapInArrow(_differ, "cell long, place int, n long")
        differ = differ.groupBy("cell", "place").agg(F.sum("n").alias("n"))
        # Places in which lines of the cell differ, those of most lines first; as many at most as a line has tokens.
        differ = differ.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "place"))).alias("differ"))
        differ = written(differ.select("cell", F.col("differ.place").alias("differ")), "differing")
        large = large.join(differ, "cell").withColumn("slack", F.floor(F.octet_length("tokens") / 8 * F.lit(1 - likeness) + F.lit(1e-9)))
        alike.append(large.filter("size(differ) <= slack").select("cell", "line"))
        rest = large.filter("size(differ) > slack").select("leaf", "line", "tokens", "fixed", "differ")
        cells = rest.mapInArrow(_cut(likeness), "cell long, leaf long, line long, tokens binary, fixed binary").dropDuplicates(["cell", "line"])

    def together(parts: list[DataFrame], name: str) -> DataFrame:
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.union(part)
        return written(whole, name)

    small, alike = together(small, "small-cells"), together(alike, "alike-cells")
    state = written(rows.selectExpr("line", "cast(null as long) as head"), "heads")
    while True:
        # An open line without an open line or head before it is a head; one whose first such line is a head joins that.
        pool = state.filter("head is null or head = line").selectExpr("line", "head is not null as is_head")
        inside = small.join(pool, "line").select("cell", "line", "tokens", "is_head").repartition("cell").sortWithinPartitions("cell", "line")
        lows = inside.mapInArrow(_lowest(likeness), "line long, low long, is_head boolean")
        met = alike.join(pool, "line")
        first = met.groupBy("cell").agg(F.min(F.struct("line", "is_head")).alias("first"))
        more = met.join(first, "cell").filter("not is_head and first.line < line").selectExpr("line", "first.line as low", "first.is_head as is_head")
        lows = lows.union(more).groupBy("line").agg(F.min(F.struct("low", "is_head")).alias("first"))
        now = F.when(F.col("head").isNotNull(), F.col("head")).when(F.col("first").isNull(), F.col("line")).when(F.col("first.is_head"), F.col("first.low"))
        state = written(state.join(lows, "line", "left").select("line", now.alias("head")), "heads")
        if state.filter("head is null").isEmpty():
            return state.filter("head <> line")


def _heads(known: DataFrame, lines: DataFrame, leading: int, likeness: float, leaf_lines: int) -> DataFrame:
    """line and head of the lines that join another."""
    in_leaves = lines.filter("leaf is not null")
    shared = in_leaves.groupBy("leaf").agg(F.min("line").alias("low"), F.max("line").alias("high")).filter("low < high").select("leaf")
    at = in_leaves.join(written(shared, "shared-leaves"), "leaf").groupBy("line").agg(F.first("leaf").alias("leaf"), F.min(F.struct("doc_id", "place")).alias("at"))
    at = at.groupBy(F.col("at.doc_id").alias("doc_id")).agg(F.collect_list(F.struct(F.col("at.place").alias("place"), "line", "leaf")).alias("wanted"))
    found = known.join(written(at, "wanted"), "doc_id").select("text", "wanted").mapInArrow(_fetch, "leaf long, line long, tokens binary")
    found = written(found.dropDuplicates(["line"]), "tokens")
    # Each of these stands ``leaf_lines`` times.
    large = written(found.groupBy("leaf").count().filter(F.col("count") > leaf_lines).select("leaf"), "large-leaves")
    small = found.join(large, "leaf", "left_anti").repartition("leaf").sortWithinPartitions("leaf", "line")
    heads = small.mapInArrow(_grow_leaves(likeness), "line long, head long")
    if not large.isEmpty():
        heads = heads.union(_grow_large(found.join(large, "leaf"), likeness, leaf_lines))
    return written(heads, "templates")


def repeated_lines(docs: DataFrame, leading: int = 4, likeness: float = 0.8, least: int = 1, short: int = 8, short_docs: int = 10, leaf_lines: int = 4096) -> DataFrame:
    """doc_id, line (digest) and first_place (set where the template's first line is) of every line of a recurring template."""
    known = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scanned = known.mapInArrow(_scan(leading, likeness, least), "doc_id long, place int, leaf long, line long, n_tokens int")
    lines = written(scanned, "lines")
    heads = _heads(known, lines, leading, likeness, leaf_lines)
    placed = lines.join(heads, "line", "left").select("doc_id", "place", "line", "n_tokens", F.coalesce("head", "line").alias("template"))
    several = placed.groupBy("template").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("template")
    placed = written(placed.join(several, "template"), "placed")
    in_docs = placed.groupBy("template", "doc_id").agg(F.min("place").alias("place"), F.first("n_tokens").alias("n_tokens"))
    recurring = (
        in_docs.groupBy("template")
        .agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count(F.lit(1)).alias("n_docs"), F.first("n_tokens").alias("n_tokens"))
        .filter(F.col("n_docs") >= F.when(F.col("n_tokens") >= short, 2).otherwise(short_docs))
        .select("template", "first")
    )
    stays = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("place") == F.col("first.place"))
    return placed.join(recurring, "template").select("doc_id", "line", F.when(stays, F.col("place")).alias("first_place"))


def strip(text: str | None, drop: dict[int, int | None], least: int = 1) -> tuple[str | None, int]:
    """The text without the lines in ``drop`` (digest to the place that stays, or None), and how many went."""
    if text is None or not drop:
        return text, 0
    gone = {number for number, line, _, _ in _parsed(text, least) if line in drop and drop[line] != number}
    if not gone:
        return text, 0
    return "\n".join(line for number, line in enumerate(text.split("\n")) if number not in gone), len(gone)


def dedup_lines(docs: DataFrame, dropped: str = "n_dropped", **options) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, and how many lines went in a new column."""
    least = options.get("least", 1)
    found = repeated_lines(docs, **options)
    by_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("line", "first_place")).alias("__drop"))
    by_doc = by_doc.withColumnRenamed("doc_id", "__doc_id")

    @F.arrow_udf("struct<text: string, n: int>")
    def stripped(texts: pa.Array, drops: pa.Array) -> pa.Array:
        out, counts = [], []
        for text, drop in zip(texts, drops):
            pairs = drop.as_py() or ()
            kept, n = strip(text.as_py(), {p["line"] & 0xFFFFFFFFFFFFFFFF: p["first_place"] for p in pairs}, least)
            out.append(kept)
            counts.append(n)
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(counts, pa.int32())], ["text", "n"])

    joined = docs.join(by_doc, F.col("doc_id") == F.col("__doc_id"), "left").withColumn("__kept", stripped("text", "__drop"))
    columns = [F.col("__kept.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c != dropped]
    return joined.select(*columns, F.col("__kept.n").alias(dropped))
