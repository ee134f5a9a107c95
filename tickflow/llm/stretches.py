"""Encoding texts stretch by stretch: what stands between white space is encoded once per batch."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
#: Lower-cased stretches of printable ASCII and Latin letters of the first 256 code points. These are as any normal form has them.
plain = re.compile(f"[!-~{_LETTERS}]+").fullmatch
#: The word pattern of the vocabulary file, for plain stretches.
plain_words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+").findall
#: Bytes of text that are encoded together, and stretches whose ids are put in place together.
TEXT_BYTES, GATHERED = 4 << 20, 1 << 18


class StretchIds:
    """Texts part at ASCII white space, where no rule of the vocabulary file looks across; each different stretch of a batch is
    encoded once by ``new``. Some ``remembered`` stretches that stood in a batch twice are kept for the next texts."""

    def __init__(self, remembered: int):
        self.remembered = remembered
        self.known: dict[str, bytes] = {}

    def new(self, chunks: list[str]) -> list[bytes]:
        """Ids (32 bits each) of stretches that are not known."""
        raise NotImplementedError

    @staticmethod
    def words_of(chunk: str) -> list[str] | tuple[str] | None:
        """The normalised words of a stretch that is plain (and holds no added token), else None."""
        low = chunk.lower()
        if not plain(low) or "<|" in low:
            return None
        return (low,) if low.isalpha() else plain_words(low)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after another, and where each text begins (and the last one ends)."""
        parted = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = parted.flatten().dictionary_encode()
        chunks, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        found = list(map(self.known.get, chunks))
        new = [i for i, ids in enumerate(found) if ids is None]
        often = np.bincount(codes, minlength=len(chunks)) > 1
        if len(self.known) > self.remembered:
            self.known = {chunk: ids for chunk, ids in zip(chunks, found) if ids is not None}
        for i, ids in zip(new, self.new([chunks[i] for i in new])):
            found[i] = ids
            if often[i]:
                self.known[chunks[i]] = ids
        del chunks, new
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, first = np.frombuffer(b"".join(found), np.uint32), np.cumsum(sizes) - sizes
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        ids = np.empty(ends[-1], np.uint32)
        for at in range(0, len(codes), GATHERED):
            some = codes[at : at + GATHERED]
            place = np.arange(ends[at], ends[at + len(some)])
            ids[ends[at] : ends[at + len(some)]] = flat[place + np.repeat(first[some] - ends[at : at + len(some)], sizes[some])]
        return ids, ends[parted.offsets.to_numpy() - parted.offsets[0].as_py()]


def text_batches(batches: Iterable[pa.RecordBatch], size: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that their texts have about ``size`` bytes; a longer text is a batch of its own."""
    for batch in batches:
        total = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(total, (total[at - 1] if at else 0) + size, "right"))
            end = max(end, at + 1)
            yield batch.slice(at, end - at)
            at = end
