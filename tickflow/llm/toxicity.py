"""Toxicity: a linear classifier of character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the hashed character n-grams that occur in its lower-cased
form, each once. Their log-count ratio between the two classes scales them, and a
logistic regression is fitted on the scaled features. It learns from at most about
``per_class`` labelled texts of each class (chosen by a hash of the id, one row of an id), and
only the n-grams whose counts tell the classes apart go to the one task that fits it; scoring is
one pass over the texts, wherever they lie.

Null and empty texts have no features and score as the intercept says. If labels
of one class are missing there is nothing to learn, and every score is 0. Of
contradicting labels the higher counts; null labels and ids are not learned from.
Repeated rows score alike, and other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import in_fold, small_arrow_batches, written

ORDERS = (3, 4, 5, 6)
BITS = 18
_PIECE = 1 << 18
#: Rows of the fit that are worked on together.
_FITTED = 512


def ngrams(text: str | None, active: np.ndarray | None = None) -> np.ndarray:
    """Distinct hashed n-grams of a text, ascending; only those that ``active`` marks."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    found = []
    for start in range(0, len(points), _PIECE):
        piece = points[start : start + _PIECE + ORDERS[-1] - 1]
        hashes = piece
        for order in range(2, ORDERS[-1] + 1):
            if len(piece) < order:
                break
            hashes = hashes[:-1] * np.uint32(0x9E3779B1) + piece[order - 1 :]
            if order in ORDERS:
                ids = ((hashes ^ (hashes >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(order)) >> np.uint32(32 - BITS)
                found.append(np.unique(ids if active is None else ids[active[ids]]))
    return np.unique(np.concatenate(found)).astype(np.int32) if found else np.empty(0, np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[ngrams(text, self.weights != 0)].sum() + self.bias, -60, 60))))


def select(positive: np.ndarray, negative: np.ndarray, n1: int, n0: int, alpha: float = 10.0) -> tuple[np.ndarray, np.ndarray]:
    """From the texts of each class that hold each n-gram: the n-grams that tell the classes apart, and their log-count ratios."""
    prior = n1 / (n1 + n0)
    ratio = np.log((positive + alpha * prior) / (n1 + alpha)) - np.log((negative + alpha * (1 - prior)) / (n0 + alpha))
    kept = np.flatnonzero((np.abs(ratio) > 0.4) & (positive + negative >= 4))
    return kept, ratio[kept]


def regress(columns: np.ndarray, ends: np.ndarray, labels: np.ndarray, scale: np.ndarray, penalty: float = 2e-3, rounds: int = 80) -> tuple[np.ndarray, float]:
    """Full-batch logistic regression (adaptive steps, classes weighted alike) on rows of selected n-grams, one row after
    another in ``columns``, each up to its place in ``ends``. Rows are worked on some at a time."""
    begins = np.concatenate([[0], ends[:-1]])
    n1, n0 = labels.sum(), (~labels).sum()
    weight = np.where(labels, 0.5 / n1, 0.5 / n0)
    w, bias, seen, seen_bias = np.zeros(len(scale)), 0.0, np.full(len(scale), 1e-8), 1e-8
    for _ in range(rounds):
        scaled, gradient, total = w * scale, np.zeros(len(scale)), 0.0
        for start in range(0, len(labels), _FITTED):
            rows = slice(start, start + _FITTED)
            part = columns[begins[rows][0] : ends[rows][-1]]
            of = np.repeat(np.arange(len(ends[rows])), ends[rows] - begins[rows])
            z = np.bincount(of, scaled[part], minlength=len(ends[rows])) + bias
            error = weight[rows] * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels[rows])
            gradient += np.bincount(part, error[of], minlength=len(scale))
            total += error.sum()
        gradient = gradient * scale + penalty * w
        seen += gradient**2
        seen_bias += total**2
        w -= 0.1 * gradient / np.sqrt(seen)
        bias -= 0.5 * total / np.sqrt(seen_bias)
    return w * scale, float(bias)


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000) -> Model | None:
    """A model from labelled texts in the learning fold, or None if a class is missing.

    Of rows that share an id one is learned from. N-grams are counted where the texts lie; only counts (2^18 at most) come to the
    driver, and only those n-grams that tell the classes apart go to the task that fits.
    """
    small_arrow_batches(docs.sparkSession)
    known = labels.filter(in_fold(F.col("doc_id")) & F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).alias("__toxic"))
    counts = {r["__toxic"]: r["n"] for r in known.groupBy("__toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("__toxic"), per_class / counts[True]).otherwise(per_class / counts[False])
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    # About 2 * per_class rows at most, whatever the size of the tables.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = written(latest_by_hash(texts), "labelled")

    def count(batches):
        found = np.zeros((2, 1 << BITS), np.int64)
        rows = np.zeros(2, np.int64)
        for batch in batches:
            for flag, text in zip(batch.column("__toxic").to_pylist(), batch.column("text")):
                found[int(flag), ngrams(text.as_py())] += 1
                rows[int(flag)] += 1
        held = np.flatnonzero(found.sum(axis=0))
        # The number of rows of each class stands under an id of its own.
        ids = np.append(held, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(np.append(found[k, held], rows[k])) for k in (0, 1))], ["id", "clean", "toxic"])

    counted = texts.mapInArrow(count, "id int, clean long, toxic long").groupBy("id").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    ids, clean, toxic = (counted.column(c).to_numpy() for c in ("id", "clean", "toxic"))
    n0, n1 = (int(c[ids < 0].sum()) for c in (clean, toxic))
    if not n0 or not n1:
        return None
    totals = np.zeros((2, 1 << BITS), np.int64)
    totals[0, ids[ids >= 0]], totals[1, ids[ids >= 0]] = clean[ids >= 0], toxic[ids >= 0]
    kept, scale = select(totals[1], totals[0], n1, n0)
    sent = docs.sparkSession.sparkContext.broadcast((kept.astype(np.int32), scale))

    def chosen_only(batches):
        number = np.full(1 << BITS, -1, np.int32)
        number[sent.value[0]] = np.arange(len(sent.value[0]))
        for batch in batches:
            rows = [number[ngrams(t.as_py(), number >= 0)].tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("__toxic"), pa.array(rows, pa.binary())], ["doc_id", "__toxic", "columns"])

    def fit(batches):
        columns, flags = [], []
        for batch in batches:
            columns += [np.frombuffer(x, np.int32) for x in batch.column("columns").to_pylist()]
            flags += batch.column("__toxic").to_pylist()
        if columns:
            ends = np.cumsum([len(x) for x in columns])
            weights, bias = regress(np.concatenate(columns), ends, np.array(flags, bool), sent.value[1])
            yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([bias])], ["weights", "bias"])

    rows = texts.mapInArrow(chosen_only, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, __toxic boolean, columns binary")
    fitted = rows.repartition(1).sortWithinPartitions("doc_id").mapInArrow(fit, "weights binary, bias double").first()
    weights = np.zeros(1 << BITS, np.float32)
    weights[kept] = np.frombuffer(fitted["weights"])
    return Model(weights, fitted["bias"])


def latest_by_hash(texts: DataFrame) -> DataFrame:
    """One row per id: the text with the smallest hash. Ids that stand there very often are cut down before they are shuffled."""
    return texts.selectExpr("*", "row_number() over (partition by doc_id order by xxhash64(text), text) __nth").filter("__nth = 1").drop("__nth")


def toxicity(docs: DataFrame, model: Model | None, text: str = "text") -> Column:
    """Score between 0 and 1 of a text column, to be used on ``docs``."""
    if model is None:
        return F.lit(0.0)
    small_arrow_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        own = Model(*sent.value)
        active = own.weights != 0
        sums = np.array([own.weights[ngrams(t.as_py(), active)].sum() for t in texts], float) + own.bias
        return pa.array(1 / (1 + np.exp(-np.clip(sums, -60, 60))))

    return score(text)
