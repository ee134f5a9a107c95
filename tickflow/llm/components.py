"""Connected components of an edge list by contraction (large star, small star), as joins and aggregates.

Edges are first reduced inside each partition to a spanning forest, which takes
out most of them. Then every node is tied to the smallest node it sees, over and
over, until the list no longer changes: it then has one edge from each node to
the smallest of its component. A round is one minimum per node and one join; a node
with very many neighbours is one row of the minimum, and its edges can be split
over tasks by the join. The list is written in the shared folder after each round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import written


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of the given edges, without the smallest nodes themselves."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        label = label[label]
        while (label != label[label]).any():
            label = label[label]
        if (label == before).all():
            break
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]


def _contract(batches):
    """Forests of about a million edges at a time."""
    held, n = [], 0
    for batch in batches:
        held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        n += batch.num_rows
        if n >= 1 << 20:
            held, n = [forest(*map(np.concatenate, zip(*held)))], 0
            yield _edges(*held[0])
            held = []
    if held:
        yield _edges(*forest(*map(np.concatenate, zip(*held))))


def _edges(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long; in any direction, repeats and loops allowed; no nulls) -> (node, component),
    one row for each node but the smallest of its component."""
    edges = edges.filter("a <> b").mapInArrow(_contract, "a long, b long").distinct()
    edges, before = written(edges, "edges"), None
    while True:
        # a > b in all rows. Large star: larger neighbours of a node go to the smallest node it sees.
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("n", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: smaller neighbours, and the node itself, go to the smallest.
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(least, F.col("a") == F.col("n")).selectExpr("b as a", "m as b").union(least.selectExpr("n as a", "m as b"))
        edges = written(small.filter("a <> b").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
