"""Language identification by a small convolutional network over bytes, trained and applied in numpy.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes, the last one padded.
Bytes are embedded; filters of several widths run over each window; the largest
value of each filter in a window goes into a softmax over the languages. A text's
prediction is the mean over all of its windows.

Training takes windows from at most about ``sample`` labelled texts (chosen by a hash of
the id), so that the one task which fits the network has a fixed bound.
Prediction is one pass over whole texts.

Texts that are null or have no letter are ``und`` with score 0, and so is
everything if there is nothing to learn from. Null labels and ids are not learned
from. Repeated rows are predicted alike; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import in_fold

WINDOW, EMBEDDING, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 16
_LETTER = regex.compile(r"\p{L}")


def windows(text: str) -> np.ndarray:
    """The whole text as rows of ``WINDOW`` bytes; the last is padded with zeros."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    rows = max(1, -(-len(data) // WINDOW))
    out = np.zeros((rows, WINDOW), np.uint8)
    out.ravel()[: len(data)] = data
    return out


@dataclass
class Network:
    """``table`` embeds bytes; ``kernels`` and ``biases`` by width; ``top`` and ``top_bias`` for the softmax."""

    table: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    top: np.ndarray
    top_bias: np.ndarray
    languages: list[str]

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 11) -> Network:
        chance = np.random.default_rng(seed)
        draw = lambda *shape, scale: (chance.standard_normal(shape) * scale).astype(np.float32)
        kernels = [draw(w * EMBEDDING, FILTERS, scale=(2 / (w * EMBEDDING)) ** 0.5) for w in WIDTHS]
        total = FILTERS * len(WIDTHS)
        zero = lambda n: np.zeros(n, np.float32)
        return cls(draw(256, EMBEDDING, scale=0.5), kernels, [zero(FILTERS) for _ in WIDTHS], draw(total, len(languages), scale=0.1), zero(len(languages)), languages)

    def parameters(self) -> list[np.ndarray]:
        return [self.table, *self.kernels, *self.biases, self.top, self.top_bias]

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest filter values of each window, and where they are."""
        embedded = self.table[rows].reshape(len(rows), WINDOW * EMBEDDING)
        values, places = [], []
        for width, kernel, bias in zip(WIDTHS, self.kernels, self.biases):
            spans = np.lib.stride_tricks.sliding_window_view(embedded, width * EMBEDDING, axis=1)[:, ::EMBEDDING]
            scores = spans.reshape(-1, width * EMBEDDING) @ kernel
            scores = scores.reshape(len(rows), -1, FILTERS)
            at = scores.argmax(axis=1)
            places.append(at)
            values.append(np.take_along_axis(scores, at[:, None, :], axis=1)[:, 0] + bias)
        return np.maximum(np.concatenate(values, axis=1), 0), places

    def largest(self, rows: np.ndarray) -> np.ndarray:
        """Like ``pooled``, values alone; the product of byte and kernel is looked up."""
        out = []
        for width, kernel, bias in zip(WIDTHS, self.kernels, self.biases):
            span = WINDOW - width + 1
            parts = [self.table @ kernel[i * EMBEDDING : (i + 1) * EMBEDDING] for i in range(width)]
            scores = parts[0][rows[:, :span]]
            for i in range(1, width):
                scores += parts[i][rows[:, i : i + span]]
            out.append(scores.max(axis=1) + bias)
        return np.maximum(np.concatenate(out, axis=1), 0)

    def chances(self, hidden: np.ndarray) -> np.ndarray:
        z = hidden @ self.top + self.top_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def step(self, rows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy."""
        hidden, places = self.pooled(rows)
        error = self.chances(hidden)
        error[np.arange(len(rows)), target] -= 1
        error /= len(rows)
        back = (error @ self.top.T) * (hidden > 0)
        table = np.zeros_like(self.table)
        kernels = []
        for i, (width, kernel) in enumerate(zip(WIDTHS, self.kernels)):
            own = back[:, i * FILTERS : (i + 1) * FILTERS]
            spot = places[i][:, :, None] + np.arange(width)  # window, filter, byte of the span
            seen = rows[np.arange(len(rows))[:, None, None], spot]
            vectors = self.table[seen].reshape(len(rows), FILTERS, width * EMBEDDING)
            kernels.append(np.einsum("nfk,nf->kf", vectors, own))
            share = own[:, :, None] * kernel.T[None]
            np.add.at(table, seen.ravel(), share.reshape(-1, EMBEDDING))
        biases = [back[:, i * FILTERS : (i + 1) * FILTERS].sum(axis=0) for i in range(len(WIDTHS))]
        return [table, *kernels, *biases, hidden.T @ error, error.sum(axis=0)]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        asked = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        cut = [windows(texts[i]) for i in asked]
        if not cut:
            return out
        ends = np.cumsum([len(c) for c in cut])
        rows = np.concatenate(cut)
        chances = np.concatenate([self.chances(self.largest(rows[s : s + 64])) for s in range(0, len(rows), 64)])
        sums = np.add.reduceat(chances, ends - [len(c) for c in cut], axis=0)
        for i, total, n in zip(asked, sums, map(len, cut)):
            best = int(total.argmax())
            out[i] = (self.languages[best], float(min(1.0, total[best] / n)))
        return out


def fit(rows: np.ndarray, labels: list[str], steps: int = 900, batch: int = 96, rate: float = 8e-3, seed: int = 7) -> Network:
    """Adam over shuffled batches of windows; every language weighs as often as it is seen."""
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    net = Network.fresh(languages)
    chance = np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    order = np.concatenate([chance.permutation(len(rows)) for _ in range(-(-steps * batch // len(rows)))])
    for n in range(1, steps + 1):
        pick = order[(n - 1) * batch : n * batch]
        slow = rate * (1 - (n - 1) / steps)
        for p, g, m, v in zip(net.parameters(), net.step(rows[pick], target[pick]), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= slow * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.99**n)) + 1e-7)
    return net


def train(docs: DataFrame, sample: int = 2000, per_text: int = 4) -> Network | None:
    """A network from labelled texts of the learning fold; up to ``per_text`` windows of each, evenly over it."""
    known = docs.filter(in_fold(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = docs.filter(in_fold(F.col("doc_id")) & F.col("lang").isNotNull()).count()
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) < (1 << 30) * min(1.0, sample / max(1, n)))
    chosen = chosen.select("doc_id", "lang", "text")

    def cut(batches):
        for batch in batches:
            langs, data = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if _LETTER.search(text):
                    own = windows(text)
                    for i in np.unique(np.linspace(0, len(own) - 1, per_text).astype(int)):
                        langs.append(lang)
                        data.append(own[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(data, pa.binary())], ["lang", "data"])

    def fit_all(batches):
        langs, data = [], []
        for batch in batches:
            langs += batch.column("lang").to_pylist()
            data += batch.column("data").to_pylist()
        if langs:
            net = fit(np.frombuffer(b"".join(data), np.uint8).reshape(-1, WINDOW), langs)
            blob = b"".join(p.astype(np.float32).tobytes() for p in net.parameters())
            yield pa.RecordBatch.from_arrays([pa.array([blob]), pa.array([net.languages])], ["blob", "languages"])

    cuts = chosen.mapInArrow(cut, "lang string, data binary").repartition(1).sortWithinPartitions("lang", "data")
    found = cuts.mapInArrow(fit_all, "blob binary, languages array<string>").first()
    return found and restored(found["blob"], found["languages"])


def restored(blob: bytes, languages: list[str]) -> Network:
    net, flat = Network.fresh(list(languages)), np.frombuffer(blob, np.float32)
    for p in net.parameters():
        p[...] = flat[: p.size].reshape(p.shape)
        flat = flat[p.size :]
    return net


def language(docs: DataFrame, net: Network | None, text: str = "text") -> Column:
    """struct<lang, score> of a text column, to be used on ``docs``."""
    if net is None:
        return F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast((b"".join(p.tobytes() for p in net.parameters()), net.languages))

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        own, out = restored(*sent.value), []
        for start in range(0, len(texts), 64):
            out += own.predict(texts.slice(start, 64).to_pylist())
        langs, scores = zip(*out) if out else ((), ())
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predict(text)
