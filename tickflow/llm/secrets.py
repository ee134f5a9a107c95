"""Secret scans: fixed patterns, and two character Markov models compared by log-likelihood ratio.

The base kinds are patterns. The method adds ``markov`` spans: inside the runs of letters of the secret alphabet, as far as no base
span covers them, the stretches of ``LEAST`` or more letters that a model of random strings
explains better than a model of ordinary identifiers, by ``MARGIN`` nats at least. A stretch begins and ends where its
score is best, so ordinary words that are joined to a random string (the path of a URL, the name before a ``=``) neither hide it nor
belong to it. Both models hold the chance of a character after the one before it.

They are trained on labelled samples of a hash-chosen part of about ``sample`` texts: what the base patterns find there, and
values after a ``=`` or ``:`` that mix capitals, small letters and digits, are labelled random, other words of these texts ordinary,
but for long ones that mix them. Only counts of character pairs leave the tasks. Scanning is one pass over whole texts.

Null texts read as empty ones; without samples of both labels no span is added.
Repeated rows are scanned alike; other columns pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, in the order their kinds are listed in.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "markov")
_STEMS = ("passw", "secret", "token", "api")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
LEAST, MARGIN = 16, 10.0
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
_VALUE = re.compile(r"""[:=]\x20*["']?(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])(?=[A-Za-z+/_-]*[0-9])([A-Za-z0-9+/_-]{16,})""")
_MIXED = re.compile(r"(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9]).{16,}")
_SIZE = len(ALPHABET) + 1
_CODES = np.full(256, -1, np.int64)
_CODES[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, _SIZE)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, ordered by start, then kind."""
    found = []
    lower = text.lower()
    if any(stem in lower for stem in _STEMS):
        # Matches with too short a value are dropped, but what they cover stays covered.
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def labelled(text: str) -> tuple[list[str], list[str]]:
    """Random strings and ordinary identifiers of a text, as the base patterns tell them apart."""
    spans = base_spans(text)
    random = [text[s:e] if kind else ASSIGN.match(text, s)[2] for s, kind, e in spans]
    random = [x for x in ("".join(c for c in r if c in ALPHABET) for r in random) if len(x) >= 8]
    covered = [(s, e) for s, _, e in spans]
    for m in _VALUE.finditer(text):
        if not any(s < m.end(1) and m.start(1) < e for s, e in covered):
            random.append(m[1])
            covered.append(m.span(1))
    # Words that mix all kinds of letters may hold a secret; they are learned from as neither.
    words = [m for m in _WORD.finditer(text) if not any(s < m.end() and m.start() < e for s, e in covered)]
    ordinary = [m[0] for m in words if not _MIXED.fullmatch(m[0])]
    return random, ordinary


def pairs(words: list[str]) -> np.ndarray:
    """Counts of (character, character before), 0 standing for the start of a word."""
    out = np.zeros((_SIZE, _SIZE), np.int64)
    if words:
        codes = _CODES[np.frombuffer(("\0" + "\0".join(words)).encode("ascii"), np.uint8)]
        codes[codes < 0] = 0
        keep = codes[1:] > 0
        np.add.at(out, (codes[:-1][keep], codes[1:][keep]), 1)
    return out


@dataclass
class Models:
    """Log-likelihood ratio of random to ordinary, by (character before, character)."""

    ratio: np.ndarray

    @classmethod
    def of(cls, random: np.ndarray, ordinary: np.ndarray) -> Models:
        def log(counts):
            # Rare contexts lean on how often the character is overall.
            overall = (counts.sum(axis=0) + 1.0) / (counts.sum() + _SIZE)
            return np.log((counts + 20.0 * overall) / (counts.sum(axis=1, keepdims=True) + 20.0))

        return cls(log(random) - log(ordinary))

    def score(self, word: str) -> float:
        codes = np.concatenate([[0], _CODES[np.frombuffer(word.encode("ascii"), np.uint8)]])
        return float(self.ratio[codes[:-1], codes[1:]].sum())

    def stretches(self, word: str) -> list[tuple[int, int]]:
        """(start, end) of the stretches of a run with the best scores, from the left: one goes on while its score is above 0 and
        not ``MARGIN`` below its best, and ends where that best was."""
        codes = np.concatenate([[0], _CODES[np.frombuffer(word.encode("ascii"), np.uint8)]])
        ratios = self.ratio[codes[:-1], codes[1:]]
        if ratios[ratios > 0].sum() < MARGIN:
            return []
        found, start, score, best, end = [], 0, 0.0, 0.0, 0
        at, ratios = 0, ratios.tolist()
        while at <= len(ratios):
            over = at == len(ratios)
            if not over:
                score += ratios[at]
                if score > best:
                    best, end = score, at + 1
            if over or score <= 0 or score < best - MARGIN:
                if best >= MARGIN and end - start >= LEAST:
                    found.append((start, end))
                    at = max(end - 1, 0)  # what follows the stretch is looked at anew
                elif over:
                    break
                start, score, best, end = at + 1, 0.0, 0.0, at + 1
                if over and at + 1 >= len(ratios):
                    break
            at += 1
        return found

    def spans(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        found = []
        for m in _RUN.finditer(text):
            free = m.start()
            # The parts of the run between base spans, which may overlap each other.
            for s, _, e in [x for x in base if x[0] < m.end() and m.start() < x[2]] + [(m.end(), 0, m.end())]:
                if s - free >= LEAST:
                    found += [(free + a, 3, free + b) for a, b in self.stretches(text[free:s])]
                free = max(free, e)
        return sorted(base + found)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def train(docs: DataFrame, sample: int = 20_000) -> Models | None:
    n = docs.count()
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("secrets")), F.lit(1 << 30)) < (1 << 30) * min(1.0, sample / max(1, n)))

    def count(batches):
        random, ordinary = np.zeros((_SIZE, _SIZE), np.int64), np.zeros((_SIZE, _SIZE), np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                a, b = labelled(text or "")
                random += pairs(a)
                ordinary += pairs(b)
        counts = np.stack([random, ordinary]).ravel()
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["at", "n"])

    # At most one row per label and pair of characters.
    rows = chosen.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(2 * _SIZE * _SIZE)
    for r in rows:
        counts[r["at"]] = r["n"]
    random, ordinary = counts.reshape(2, _SIZE, _SIZE)
    return Models.of(random, ordinary) if random.sum() and ordinary.sum() else None


def scan(docs: DataFrame, models: Models | None, text: str = "text") -> Column:
    """struct<base, spans>: the lists of base and of all spans of a text column, to be used on ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf("struct<base: string, spans: string>")
    def find(texts: pa.Array) -> pa.Array:
        own, base, every = sent.value, [], []
        for value in texts:
            content = value.as_py() or ""
            spans = base_spans(content)
            base.append(listed(spans))
            every.append(listed(own.spans(content, spans) if own else spans))
        return pa.StructArray.from_arrays([pa.array(base, pa.string()), pa.array(every, pa.string())], ["base", "spans"])

    return find(text)
