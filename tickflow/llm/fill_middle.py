"""Fill-in-middle: a text is cut into prefix, middle and suffix, and written with the middle last.

The cuts are numbers of code points; where they lie in the UTF-8 bytes is asked of a
learned rank index of the text: its boundary offsets (rank -> byte) are covered by line segments
that miss none by more than ``BOUND`` bytes, and the residual of each boundary is kept in a byte.
A lookup predicts with its segment's line and adds the residual, so it is exact. The index is built
a bounded stretch of the text at a time; it takes one byte a code point and a few numbers a segment.

Only the two byte offsets come back from Python; texts are cut and joined as columns. Nothing is shuffled.

Null texts count as empty. Empty texts, texts that hold a marker, and a share of the others stay
plain. Chance comes from a hash of the seed and the id: reruns agree, rows with equal ids are cut by
the same numbers, and a null id hashes like an empty one. Every row gives one row; columns other than
``doc_id`` and ``text`` are not looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: Opens the prefix, the suffix and the middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Most bytes a segment's line may be off, so that a residual fits in a signed byte after rounding.
BOUND = 126
_STRETCH = 1 << 20
_FITTED = 4096


@dataclass
class RankIndex:
    """Byte offset of every code point boundary of a text."""

    first: list[int] = field(default_factory=list)  # rank where a segment begins
    base: list[int] = field(default_factory=list)
    slope: list[float] = field(default_factory=list)
    residuals: list[np.ndarray] = field(default_factory=list)
    n: int = 0

    def add(self, offsets: np.ndarray) -> None:
        """Cover the next boundaries."""
        at = 0
        while at < len(offsets):
            end, slope = _segment(offsets, at)
            predicted = offsets[at] + np.floor(slope * np.arange(end - at)).astype(np.int64)
            self.first.append(self.n + at)
            self.base.append(int(offsets[at]))
            self.slope.append(slope)
            self.residuals.append((offsets[at:end] - predicted).astype(np.int8))
            at = end
        self.n += len(offsets)

    def byte(self, rank: int) -> int:
        """Where the first ``rank`` code points end."""
        k = int(np.searchsorted(self.first, rank, "right")) - 1
        inside = rank - self.first[k]
        return self.base[k] + int(np.floor(self.slope[k] * inside)) + int(self.residuals[k][inside])


def _segment(offsets: np.ndarray, at: int) -> tuple[int, float]:
    """The longest segment from ``at`` on that one line through its first boundary covers: its end and slope.

    Every further boundary narrows the cone of slopes that pass within ``BOUND`` of all so far.
    """
    low, high = 1.0, 4.0  # bytes of a code point
    done = at + 1
    while done < len(offsets):
        part = offsets[done : done + _FITTED]
        steps = np.arange(done - at, done - at + len(part))
        rise = part - offsets[at]
        lows = np.maximum.accumulate(np.maximum((rise - BOUND) / steps, low))
        highs = np.minimum.accumulate(np.minimum((rise + BOUND) / steps, high))
        if lows[-1] > highs[-1]:
            fits = int(np.argmax(lows > highs))
            if fits:
                low, high = lows[fits - 1], highs[fits - 1]
            return done + fits, float(low + high) / 2
        low, high = lows[-1], highs[-1]
        done += len(part)
    return done, float(low + high) / 2


def rank_index(text: bytes) -> RankIndex:
    """The index of a text in UTF-8, its end included."""
    index = RankIndex()
    data = np.frombuffer(text, np.uint8)
    for start in range(0, len(data), _STRETCH):
        index.add(np.flatnonzero((data[start : start + _STRETCH] & 0xC0) != 0x80) + start)
    index.add(np.array([len(data)]))
    return index


@F.arrow_udf(StructType([StructField("first", IntegerType()), StructField("second", IntegerType())]))
def _cuts(texts: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    """Byte offsets of two ranks in each text; null where the text is."""
    found: list[list] = [[], []]
    for text, *ranks in zip(texts, first.to_pylist(), second.to_pylist()):
        index = rank_index(text.as_buffer().to_pybytes()) if text.is_valid else None
        for out, rank in zip(found, ranks):
            out.append(None if index is None else index.byte(rank))
    return pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in found], ["first", "second"])


def fill_in_middle(docs: DataFrame, seed: int = 1, transformed: int = 90, suffix_first: int = 20) -> DataFrame:
    """(doc_id, text) -> doc_id, n, form, prefix_chars, middle_chars, output; a row for every row.

    ``transformed`` percent of the texts are rewritten, of these ``suffix_first`` percent as ``spm``, the others as ``psm``.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), digest.alias("hash"))
    h = [F.conv(F.substring("hash", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = rows.select("doc_id", "text", F.length("text").cast("long").alias("n"), *h)
    marked = F.col("text").contains(MARKERS[0]) | F.col("text").contains(MARKERS[1]) | F.col("text").contains(MARKERS[2])
    plain = (F.col("n") == 0) | marked | (F.col("h3") % 100 >= transformed)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm")
    one, two = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    rows = rows.select("doc_id", "text", "n", form.alias("form"), F.least(one, two).alias("a"), F.greatest(one, two).alias("b"))
    whole = F.when(F.col("form") != "plain", F.col("text")).cast("binary")
    rows = rows.withColumn("cut", _cuts(whole, "a", "b")).withColumn("bytes", F.col("text").cast("binary"))
    part = lambda start, end: F.substring("bytes", start + 1, end - start).cast("string")
    first, second = F.col("cut.first"), F.col("cut.second")
    prefix, middle, suffix = part(F.lit(0), first), part(first, second), part(second, F.octet_length("bytes"))
    p, s, m = map(F.lit, MARKERS)
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
    )
    size = lambda x: F.when(F.col("form") != "plain", x)
    return rows.select(
        "doc_id", "n", "form", size(F.col("a")).alias("prefix_chars"), size(F.col("b") - F.col("a")).alias("middle_chars"), output.alias("output")
    )


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that gave ``output``: a rewritten text holds no marker of its own, so the markers part it."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = F.split(output, "|".join(MARKERS), -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(part[1], part[3], part[2])).otherwise(F.concat(part[2], part[3], part[1]))
