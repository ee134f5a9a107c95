"""Embedding near-dedup by an epsilon grid order join.

Vectors are normalised and turned to their leading principal dimensions; cosine
of at least c is then a distance of at most epsilon = sqrt(2 - 2c). They are sorted by
the cells of a grid over these dimensions and cut into blocks of consecutive rows.
The join of the sequence with itself is recursive: a pair of intervals is dropped if their boxes lie
further apart than epsilon, else its halves meet, down to pairs of blocks. Levels are
equi-joins of small box tables; pairs of blocks are worked on by matrix products,
in which smaller stretches are again skipped by their boxes. What lies near the threshold is
computed again in double precision.

Equal vectors are one node with a weight from the start. A pair of blocks hands on, for each
vector, its weighted number of links and the edges of a spanning forest: a dense group
of any size emits no pairs. Work on a dense group is still quadratic in products, as every
link is counted; blocks bound what a task holds.

Vectors that are null, empty, zero, or hold null or non-finite components link with
nothing, and so do rows without an id; vectors of different lengths do not link. Rows that share an
id are one vector; if they differ, the one with the smallest hash is compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import runs, written
from tickflow.llm.components import components, forest

LEADING, BLOCK, STRETCH, FAN_BITS = 8, 4096, 256, 2


def _rows(column) -> np.ndarray:
    """Equally long lists as a matrix."""
    return np.array(column.to_pylist(), np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square is out of range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _moments(batches):
    """Per number of dimensions: count, sum and products of the normalised vectors."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for d in np.unique(dims).tolist():
            x = _unit(_rows(batch.column("vector").filter(pa.array(dims == d))))
            row = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
            found[d] = found[d] + row if d in found else row
    yield from _moment_rows(found)


def _sum_moments(batches):
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for d, blob in zip(batch.column("dim").to_pylist(), batch.column("moments").to_pylist()):
            row = np.frombuffer(blob, np.float64)
            found[d] = found[d] + row if d in found else row
    yield from _moment_rows(found)


def _moment_rows(found):
    for d, row in found.items():
        yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([row.tobytes()])], ["dim", "moments"])


def bases(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal dimensions by vector length, from all vectors. One small row per length reaches the driver."""
    schema = "dim int, moments binary"
    sums = vectors.mapInArrow(_moments, schema).repartition("dim").mapInArrow(_sum_moments, schema).collect()
    out = {}
    for d, blob in sums:
        row = np.frombuffer(blob, np.float64)
        n, mean = row[0], row[1 : d + 1] / row[0]
        _, axes = np.linalg.eigh(row[d + 1 :].reshape(d, d) / n - np.outer(mean, mean))
        axes = axes[:, ::-1][:, :LEADING]
        out[d] = np.pad(axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]), ((0, 0), (0, LEADING - axes.shape[1])))
    return out


def _cells(sent, epsilon: float):
    def place(batches):
        axes = sent.value
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            coords = np.zeros((batch.num_rows, LEADING))
            for d in np.unique(dims).tolist():
                own = dims == d
                coords[own] = _unit(_rows(batch.column("vector").filter(pa.array(own)))) @ axes[d]
            cells = np.floor(coords / epsilon).astype(np.int64)
            flat = lambda x, t: pa.ListArray.from_arrays(np.arange(0, x.size + 1, LEADING, dtype=np.int32), pa.array(x.ravel(), t))
            columns = [batch.column(c) for c in ("node", "weight", "dim", "vector")] + [flat(cells, pa.int64()), flat(coords, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "weight", "dim", "vector", "cells", "coords"])

    return place


def _pack(batches):
    """One row per block."""
    for group in runs(batches, ["dim", "block"]):
        coords = _rows(group.column("coords"))
        blob = lambda x, t: pa.array([np.ascontiguousarray(x, t).tobytes()])
        columns = [pa.array([group.column(c)[0].as_py()], t) for c, t in (("dim", pa.int32()), ("block", pa.int64()))]
        columns += [blob(group.column("node").to_numpy(), np.int64), blob(group.column("weight").to_numpy(), np.int64)]
        columns += [blob(_rows(group.column("vector")), np.float64), blob(coords, np.float64)]
        columns += [pa.array([list(coords.min(axis=0))]), pa.array([list(coords.max(axis=0))])]
        yield pa.RecordBatch.from_arrays(columns, ["dim", "block", "nodes", "weights", "vectors", "coords", "low", "high"])


def _near(low_a, high_a, low_b, high_b, epsilon: float) -> np.ndarray:
    """Which boxes of a (rows) and b (columns) are within epsilon of each other."""
    gap = np.maximum(0, np.maximum(low_a[:, None] - high_b[None], low_b[None] - high_a[:, None]))
    return (gap * gap).sum(axis=2) <= epsilon * epsilon * (1 + 1e-9)


def _boxes(coords: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.arange(0, len(coords), STRETCH)
    return np.minimum.reduceat(coords, starts), np.maximum.reduceat(coords, starts)


def _join(cosine: float, epsilon: float):
    def join(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                yield from _block_pair(row, cosine, epsilon)

    return join


def _block_pair(row: dict, cosine: float, epsilon: float):
    d, same = row["dim"], row["a"] == row["b"]
    take = lambda c, t, n=1: np.frombuffer(row[c], t).reshape(-1, n) if n > 1 else np.frombuffer(row[c], t)
    node_a, node_b = take("nodes_a", np.int64), take("nodes_b", np.int64)
    weight_a, weight_b = take("weights_a", np.int64), take("weights_b", np.int64)
    x, y = (_unit(np.frombuffer(row[c], np.float64).reshape(-1, d)) for c in ("vectors_a", "vectors_b"))
    x32, y32 = x.astype(np.float32), y.astype(np.float32)
    near = _near(*_boxes(take("coords_a", np.float64, LEADING)), *_boxes(take("coords_b", np.float64, LEADING)), epsilon)
    links_a, links_b = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(len(near)):
        start = k * STRETCH
        part = slice(start, min(start + STRETCH, len(x)))
        columns = np.flatnonzero(np.repeat(near[k], STRETCH)[: len(y)])
        if same:
            columns = columns[columns > start]
        if not len(columns):
            continue
        close = x32[part] @ y32[columns].T
        linked = close >= cosine
        i, j = np.nonzero(np.abs(close - cosine) < 3e-4)
        if len(i):
            linked[i, j] = (x[start + i] * y[columns[j]]).sum(axis=1) >= cosine
        if same:
            linked &= columns[None] > np.arange(part.start, part.stop)[:, None]
        i, j = np.nonzero(linked)
        if len(i):
            i, j = start + i, columns[j]
            np.add.at(links_a, i, weight_b[j])
            np.add.at(links_a if same else links_b, j, weight_a[i])
            ends.append(forest(node_a[i], node_b[j]))
    for node, links in ((node_a, links_a), (node_b, links_b)):
        at = np.flatnonzero(links)
        if len(at):
            yield _out(node[at], None, links[at])
    if ends:
        yield _out(*forest(*map(np.concatenate, zip(*ends))), None)


def _out(a, b, links) -> pa.RecordBatch:
    columns = [pa.array(x, pa.int64()) if x is not None else pa.nulls(len(a), pa.int64()) for x in (a, b, links)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "links"])


def _ordered(placed: DataFrame, epsilon: float) -> DataFrame:
    """Rows with ``block``, their place in the grid order of vectors of their length, by ``BLOCK``."""
    spark = placed.sparkSession
    order = ["dim", *[F.col("cells")[i] for i in range(LEADING)], "node"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sequence = placed.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    sequence = written(sequence, "sequence")
    sizes = sequence.groupBy("dim", "part").agg(F.count(F.lit(1)).alias("n"))
    # One row for each partition and vector length.
    before = sizes.selectExpr("dim", "part", "coalesce(sum(n) over (partition by dim order by part rows between unbounded preceding and 1 preceding), 0) as before")
    cells = ", ".join(f"cells[{i}]" for i in range(LEADING))
    numbered = sequence.selectExpr("*", f"row_number() over (partition by dim, part order by {cells}, node) - 1 as inside")
    return numbered.join(before, ["dim", "part"]).withColumn("at", F.col("before") + F.col("inside")).withColumn("block", F.expr(f"at div {BLOCK}"))


def block_pairs(blocks: DataFrame, epsilon: float) -> DataFrame:
    """(dim, a <= b) of blocks that may hold links, by recursion over intervals of the sequence."""
    bounds = [F.col("low")[i].alias(f"low{i}") for i in range(LEADING)] + [F.col("high")[i].alias(f"high{i}") for i in range(LEADING)]
    level = written(blocks.select("dim", F.col("block").alias("at"), *bounds), "boxes")
    last = level.agg(F.max("at")).first()[0] or 0
    levels = [level]
    while last:
        last >>= FAN_BITS
        lows = [F.min(f"low{i}").alias(f"low{i}") for i in range(LEADING)]
        highs = [F.max(f"high{i}").alias(f"high{i}") for i in range(LEADING)]
        level = level.groupBy("dim", F.shiftright("at", FAN_BITS).alias("at")).agg(*lows, *highs)
        levels.append(level)
    pairs = levels[-1].select("dim", F.col("at").alias("a"), F.col("at").alias("b"))
    gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"l.low{i}") - F.col(f"r.high{i}"), F.col(f"r.low{i}") - F.col(f"l.high{i}")), 2) for i in range(LEADING)), F.lit(0.0))
    for level in reversed(levels[:-1]):
        below = level.withColumn("above", F.shiftright("at", FAN_BITS))
        left = pairs.withColumnRenamed("a", "above").join(below.alias("l"), ["dim", "above"]).selectExpr("dim", "b", "struct(l.*) as l")
        both = left.withColumnRenamed("b", "above").join(below.alias("r"), ["dim", "above"]).selectExpr("dim", "l", "struct(r.*) as r")
        near = both.filter((F.col("l.at") <= F.col("r.at")) & (gap <= epsilon * epsilon * (1 + 1e-9)))
        pairs = near.select("dim", F.col("l.at").alias("a"), F.col("r.at").alias("b"))
    return pairs


def near_vectors(rows: DataFrame, cosine: float = 0.95) -> DataFrame:
    """(vec_id, embedding) -> vec_id, n_links, component_id, kept; one row per row."""
    spark = rows.sparkSession
    epsilon = float(np.sqrt(2 - 2 * cosine))
    vector = F.col("embedding").cast("array<double>")
    every = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = every.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~odd & F.exists("vector", lambda x: x != 0))
    good = good.withColumn("hash", F.struct(F.xxhash64("vector"), F.xxhash64(F.lit(1), "vector")))
    ids = good.groupBy("vec_id").agg(F.min("hash").alias("hash"))
    equal = ids.groupBy("hash").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"))
    named = written(ids.join(equal, "hash"), "vectors")
    first = named.filter("vec_id = node").select("vec_id", "hash", "weight")
    nodes = good.join(first, ["vec_id", "hash"]).dropDuplicates(["vec_id"])
    nodes = written(nodes.select(F.col("vec_id").alias("node"), "weight", F.size("vector").alias("dim"), "vector"), "nodes")
    sent = spark.sparkContext.broadcast(bases(nodes.select("dim", "vector")))
    placed = nodes.mapInArrow(_cells(sent, epsilon), "node long, weight long, dim int, vector array<double>, cells array<long>, coords array<double>")
    ordered = _ordered(placed, epsilon).select("dim", "block", "at", "node", "weight", "vector", "coords")
    packed = ordered.repartition("dim", "block").sortWithinPartitions("dim", "block", "at").mapInArrow(
        _pack, "dim int, block long, nodes binary, weights binary, vectors binary, coords binary, low array<double>, high array<double>"
    )
    blocks = written(packed, "blocks")
    pairs = written(block_pairs(blocks, epsilon), "block-pairs")
    data = ["nodes", "weights", "vectors", "coords"]
    side = lambda s: blocks.select("dim", F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in data])
    # Pairs are dealt out one by one before the blocks come to them.
    met = pairs.join(side("a"), ["dim", "a"]).join(side("b"), ["dim", "b"])
    found = written(met.mapInArrow(_join(cosine, epsilon), "a long, b long, links long"), "links")
    links = found.filter("links is not null").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "node")
    classes = components(found.filter("b is not null").select("a", "b"))
    known = named.join(links, "node", "left").join(classes, "node", "left").select(
        F.col("vec_id").alias("__id"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("__links"),
        F.coalesce("component", "node").alias("__class"),
    )
    out = every.select("vec_id").join(known, F.col("vec_id") == F.col("__id"), "left")
    out = out.select("vec_id", F.coalesce("__links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("__class", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
