"""MinHash near-dedup with sequential Bayesian verification.

1. Each text becomes its set of distinct shingles (64-bit hashes of word runs), a
   signature of ``HASHES`` minima kept to a byte each, and ``bands`` band keys.
   Texts with equal sets are one node from here on.
2. In each band bucket every node is paired with the smallest one: as many pairs
   as members. A pair's signatures are compared batch by batch, and it is dropped
   as soon as the posterior probability that its likeness reaches the threshold
   falls below ``miss``. Survivors are verified on their full sets.
3. Where many members of a bucket are outside its largest component, they are paired with the member
   that is most like their consensus (each byte of a signature as most of some ``_PROBES`` of them have it): copies of one text
   are most like that text. Again as many pairs as members; that goes on as long as it links anything.
4. In buckets whose members are still in different components, the members outside
   the largest component, now few, meet all others, in tiles of bounded size. Each hands on the
   one partner in another component whose signature is most alike, which is
   verified; that goes on as long as it links anything, and joins groups around whatever text they were copied from.
5. What is then still apart meets a last time. Members with a partner that passes the test take their full sets to tiles,
   in which all pairs across components that pass it are verified; of the links found, a tile hands on those that join
   components it did not see joined before. Pairs inside a component need no look, as they change nothing.

Results are components, so this loses no link between different texts that a
bucket holds. The only errors are of the banding and of ``miss``.
Signatures and band keys are what is stored and shuffled; texts, or their sets, move only for
members of pairs that have passed the test. No bucket is capped, and no step hands on more rows than its buckets or tiles have members.

Null texts and texts without words have no shingles and link with nothing; a text
with fewer words than a shingle is one shingle. Rows without an id link with nothing.
Rows that share an id are one document; if their texts differ, the one with the smallest hash is compared.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType

from tickflow.llm.common import WordIds, mix, runs, small_arrow_batches, small_batches, written
from tickflow.llm.components import components

HASHES, BAND_ROWS, BATCH = 128, 5, 16
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ROWS, _COLUMNS = 1024, 4096
#: Shingles that the rows and the columns of a tile bring along where full sets meet (8 bytes each).
_ROW_SHINGLES, _COLUMN_SHINGLES = 1 << 20, 1 << 22
_PROBES = 64
#: Ids of texts to be verified are broadcast up to this many (some 10 MB), and joined by a shuffle beyond.
_BROADCAST_IDS = 500_000


def _constants() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:HASHES] | np.uint64(1), seeds[HASHES:]


def shingles(text: str | None, size: int, ids: WordIds) -> np.ndarray:
    """Distinct hashes of the runs of ``size`` words, ascending. Upper-case A-Z count as lower case."""
    words = np.array([ids[w] for w in (text or "").encode("utf-8", "replace").translate(_LOWER).split()], np.uint64)
    if len(words) == 0:
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out = (out + words[i : i + len(out)]) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(i + 1)
        out ^= out >> np.uint64(29)
    return np.unique(mix(out + np.uint64(size)))


def signature(members: np.ndarray) -> np.ndarray:
    """The smallest of each hash function's 32-bit values over a set."""
    factors, terms = _constants()
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    step = max(1, (1 << 21) // HASHES)
    for start in range(0, len(members), step):
        part = members[start : start + step]
        np.minimum(best, ((part[None, :] * factors[:, None] + terms[:, None]) >> np.uint64(32)).astype(np.uint32).min(axis=1), out=best)
    return best


@lru_cache
def least_matches(threshold: float, miss: float) -> np.ndarray:
    """How many of the first n bytes of two signatures must agree for the pair to go on, for n = 0, BATCH, ..

    Prior: likeness uniform on 0..1. Two bytes agree with probability s + (1 - s) / 256.
    """
    s = (np.arange(2000) + 0.5) / 2000
    agree = s + (1 - s) / 256
    out = [0]
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(agree) + (n - m) * np.log1p(-agree)
            posterior = np.exp(log - log.max())
            if posterior[s >= threshold].sum() / posterior.sum() >= miss:
                break
        out.append(m)
    return np.array(out)


def _survive(left: np.ndarray, right: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of signatures pass every batch, and their matches; each batch is compared for those left only."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for step in range(1, len(least)):
        part = slice((step - 1) * BATCH, step * BATCH)
        matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1)
        going = matches >= least[step]
        alive, matches = alive[going], matches[going]
    return alive, matches


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), HASHES)


def _sketch(size: int, bands: int):
    def sketch(batches):
        ids = WordIds(100_000)
        for batch in small_batches(batches):
            counts, ones, twos, signatures, keys = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                members = shingles(text, size, ids)
                counts.append(len(members))
                with np.errstate(over="ignore"):
                    ones.append(int(mix(members).sum(dtype=np.uint64)))
                    twos.append(int(mix(members ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)))
                if not len(members):
                    signatures.append(None)
                    keys.append(None)
                    continue
                minima = signature(members)
                signatures.append(mix(minima).astype(np.uint8).tobytes())
                rows = minima[: bands * BAND_ROWS].astype(np.uint64).reshape(bands, BAND_ROWS)
                key = np.arange(bands, dtype=np.uint64)
                for i in range(BAND_ROWS):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
                keys.append(key.view(np.int64))
            wide = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(counts, pa.int64()), wide(ones), wide(twos), pa.array(signatures, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "mark", "n_shingles", "one", "two", "signature", "bands"],
            )

    return sketch


def _bayes(threshold: float, miss: float):
    def test(batches):
        least = least_matches(threshold, miss)
        for batch in batches:
            if batch.num_rows:
                alive, _ = _survive(_matrix(batch.column("left")), _matrix(batch.column("right")), least)
                yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(alive)), batch.column("b").take(pa.array(alive))], ["a", "b"])

    return test


def _across(tile: pa.Table, node: np.ndarray, own: np.ndarray, least: np.ndarray, each_way: bool):
    """For each row of a tile, those of its columns in another component that pass the test, and their matches.

    Two members outside the largest component meet from the smaller one's side only, unless ``each_way``. ``own`` may
    change between the rows.
    """
    row, minor = (tile.column(c).to_numpy() for c in ("row", "minor"))
    marks = _matrix(tile.column("signature"))
    columns = np.flatnonzero(~row)
    for i in np.flatnonzero(row):
        asked = columns[(own[columns] != own[i]) & (~minor[columns] | (node[columns] > node[i]) | each_way)]
        alive, matches = _survive(np.broadcast_to(marks[i], (len(asked), HASHES)), marks[asked], least)
        if len(alive):
            yield i, asked[alive], matches


def _best(threshold: float, miss: float):
    """Pairs across components inside a tile: each of its few rows with the column most like it."""

    def test(batches):
        least = least_matches(threshold, miss)
        for tile in runs(batches, ["bucket", "first", "second"]):
            node, own = (tile.column(c).to_numpy() for c in ("node", "component"))
            for i, alive, matches in _across(tile, node, own, least, True):
                ends = sorted((node[i], node[alive[matches.argmax()]]))
                yield pa.RecordBatch.from_arrays([pa.array(ends[:1]), pa.array(ends[1:])], ["a", "b"])

    return test


def _partnered(threshold: float, miss: float):
    """Members of a tile with a partner across components that passes the test."""

    def test(batches):
        least = least_matches(threshold, miss)
        for tile in runs(batches, ["bucket", "first", "second"]):
            node, own = (tile.column(c).to_numpy() for c in ("node", "component"))
            found = np.zeros(len(node), bool)
            for i, alive, _ in _across(tile, node, own, least, False):
                found[i] = True
                found[alive] = True
            if found.any():
                nodes = np.unique(node[found])
                bucket = np.full(len(nodes), tile.column("bucket")[0].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(nodes)], ["bucket", "node"])

    return test


def _links(threshold: float, miss: float, percent: int):
    """Links across components inside a tile, verified on the full sets: of all there are, those that join what was not joined before."""

    def test(batches):
        least = least_matches(threshold, miss)
        for tile in runs(batches, ["bucket", "first", "second"]):
            node, own = tile.column("node").to_numpy(), tile.column("component").to_numpy().copy()
            values = tile.column("members").to_pylist()
            sizes = np.array([len(v) // 8 for v in values])
            distinct, flat = np.unique(np.frombuffer(b"".join(values), np.int64), return_inverse=True)
            flat = flat.astype(np.int32)
            del values
            ends = np.cumsum(sizes)
            begins = ends - sizes
            held = np.zeros(len(distinct), bool)
            a, b = [], []
            for i, alive, _ in _across(tile, node, own, least, False):
                held[flat[begins[i] : ends[i]]] = True
                # As many sets at a time as hold some four million shingles, and at least one.
                for part in np.split(alive, np.flatnonzero(np.diff(np.cumsum(sizes[alive]) >> 22)) + 1):
                    n = sizes[part]
                    firsts = np.cumsum(n) - n
                    common = np.add.reduceat(held[flat[np.arange(n.sum()) + np.repeat(begins[part] - firsts, n)]], firsts, dtype=np.int64)
                    linked = part[100 * common >= percent * (sizes[i] + n - common)]
                    for component in np.unique(own[linked]):
                        if component != own[i]:
                            partner = linked[own[linked] == component][0]
                            a.append(min(node[i], node[partner]))
                            b.append(max(node[i], node[partner]))
                            own[own == component] = own[i]
                held[flat[begins[i] : ends[i]]] = False
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return test


@F.arrow_udf(BinaryType())
def _consensus(groups: pa.Array) -> pa.Array:
    """At each place the byte that most signatures of a list have."""
    out = []
    for signatures in groups:
        rows = _matrix(signatures.values)
        counts = np.zeros((HASHES, 256), np.int32)
        np.add.at(counts, (np.arange(HASHES)[None, :], rows), 1)
        out.append(counts.argmax(axis=1).astype(np.uint8).tobytes())
    return pa.array(out, pa.binary())


@F.arrow_udf(IntegerType())
def _likeness(left: pa.Array, right: pa.Array) -> pa.Array:
    """How many bytes of two signatures agree."""
    return pa.array((_matrix(left) == _matrix(right)).sum(axis=1), pa.int32())


def _verify(size: int, percent: int):
    """Exact likeness of pairs, on the full sets; the last texts' sets are remembered."""

    def verify(batches):
        ids, known = WordIds(100_000), {}

        def members(node: int, text: str) -> np.ndarray:
            if node not in known:
                if len(known) >= 64:
                    known.clear()
                known[node] = shingles(text, size, ids)
            return known[node]

        for batch in small_batches(batches, 128):
            keep = []
            for i, (a, b, left, right) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "b", "left", "right")))):
                x, y = members(a, left), members(b, right)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")], ["a", "b"])

    return verify


def _sets(size: int):
    """Shingles of texts, as bytes."""

    def sets(batches):
        ids = WordIds(100_000)
        for batch in small_batches(batches):
            members = [shingles(text, size, ids).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(members, pa.binary())], ["node", "members"])

    return sets


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 24, miss: float = 1e-5) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept; one row per row of ``docs`` (doc_id, text).

    Two texts are linked if 100 * shared shingles >= percent * all their shingles.
    """
    small_arrow_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("mark", F.xxhash64("text"))
    sketches = written(
        texts.mapInArrow(
            _sketch(shingle, bands), "doc_id long, mark long, n_shingles long, one long, two long, signature binary, bands array<long>"
        ),
        "sketches",
    )
    real = sketches.filter("doc_id is not null and n_shingles > 0")
    real = real.groupBy("doc_id").agg(F.min(F.struct("mark", "one", "two", "n_shingles")).alias("s")).select("doc_id", "s.*")
    # Texts with equal sets are known by the smallest of their ids.
    sets = real.groupBy("one", "two", "n_shingles").agg(F.min("doc_id").alias("node"))
    named = written(real.join(sets, ["one", "two", "n_shingles"]).select("doc_id", "mark", "node"), "nodes")
    nodes = named.filter("doc_id = node").select("doc_id", "mark")
    marks = sketches.join(nodes, ["doc_id", "mark"]).selectExpr("doc_id as node", "signature", "bands", "n_shingles").dropDuplicates(["node"])
    marks = written(marks, "marks")
    members = marks.select("node", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written(members.join(buckets, "bucket"), "buckets")

    def likely(pairs: DataFrame) -> DataFrame:
        left = marks.select(F.col("node").alias("a"), F.col("signature").alias("left"))
        right = marks.select(F.col("node").alias("b"), F.col("signature").alias("right"))
        both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
        return both.mapInArrow(_bayes(percent / 100, miss), "a long, b long")

    def texts_of(ends: DataFrame, name: str) -> DataFrame:
        """node, text of distinct nodes."""
        ends = written(ends.join(nodes, F.col("node") == F.col("doc_id")).selectExpr("node", "mark as own"), f"{name}-ends")
        few = ends.count() <= _BROADCAST_IDS
        needed = texts.join(F.broadcast(ends) if few else ends, F.col("doc_id") == F.col("node")).filter("mark = own")
        return needed.select("node", "text").dropDuplicates(["node"])

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        pairs = written(pairs, f"{name}-pairs")
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        needed = written(texts_of(ends, name), f"{name}-texts")
        both = pairs.join(needed.toDF("b", "right"), "b").join(needed.toDF("a", "left"), "a")
        return written(both.select("a", "b", "left", "right").mapInArrow(_verify(shingle, percent), "a long, b long"), f"{name}-links")

    def mixed_buckets(classes: DataFrame) -> DataFrame:
        """Members of the buckets that hold several components; the centre of a bucket has met all others and takes no part."""
        placed = shared.filter("node <> centre").join(classes, "node", "left")
        placed = placed.select("bucket", "node", F.coalesce("component", "node").alias("component"))
        mixed = placed.groupBy("bucket", "component").count().groupBy("bucket").agg(
            F.max_by("component", "count").alias("largest"), F.max("count").alias("most"), F.sum("count").alias("n")
        )
        mixed = mixed.filter("most < n").selectExpr("bucket", "largest", f"ceil((n - most) / {_ROWS}) as across", f"ceil(n / {_COLUMNS}) as down")
        return placed.join(mixed, "bucket").withColumn("minor", F.col("component") != F.col("largest"))

    def in_tiles(placed: DataFrame, brought: DataFrame) -> DataFrame:
        """Members (bucket, node, component, minor, across, down) in tiles, with what ``brought`` has of their nodes."""
        place = lambda of: F.pmod(F.xxhash64("node"), F.col(of))
        each = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
        columns = placed.select("bucket", "node", "component", "minor", F.lit(False).alias("row"), each("across").alias("first"), place("down").alias("second"))
        rows = placed.filter("minor").select("bucket", "node", "component", "minor", F.lit(True).alias("row"), place("across").alias("first"), each("down").alias("second"))
        tiles = columns.union(rows).join(brought, "node").repartition("bucket", "first", "second")
        return tiles.sortWithinPartitions("bucket", "first", "second", "node")

    def around_consensus(classes: DataFrame) -> DataFrame:
        """Pairs of members with the one most like the consensus of those outside the largest component, where these are many."""
        many = written(mixed_buckets(classes).filter("across > 1").join(marks.select("node", "signature"), "node"), "many")
        probes = many.filter("minor").selectExpr("bucket", "signature", "row_number() over (partition by bucket order by xxhash64(node)) as nth")
        probes = probes.filter(F.col("nth") <= _PROBES).groupBy("bucket").agg(F.collect_list("signature").alias("some"))
        # Written, so that no task asks Python for two things at once, which takes two workers.
        middles = written(probes.select("bucket", _consensus("some").alias("middle")), "middles")
        scored = many.join(middles, "bucket")
        scored = scored.select("bucket", "node", "component", _likeness("signature", "middle").alias("like"))
        middle = scored.groupBy("bucket").agg(F.max(F.struct("like", "node", "component")).alias("m")).select("bucket", "m.node", "m.component").toDF("bucket", "middle", "own")
        pairs = many.join(middle, "bucket").filter("component <> own")
        return pairs.select(F.least("node", "middle").alias("a"), F.greatest("node", "middle").alias("b")).distinct()

    def apart(classes: DataFrame) -> DataFrame:
        """Likely pairs across components, one for each member outside a bucket's largest component."""
        tiles = in_tiles(mixed_buckets(classes), marks.select("node", "signature"))
        return tiles.mapInArrow(_best(percent / 100, miss), "a long, b long").distinct()

    def across(classes: DataFrame) -> DataFrame:
        """All links across components of what shares a bucket, or as many as join the same components."""
        placed = mixed_buckets(classes)
        found = in_tiles(placed, marks.select("node", "signature")).mapInArrow(_partnered(percent / 100, miss), "bucket long, node long").distinct()
        found = written(found, "partnered")
        if found.isEmpty():
            return found.selectExpr("bucket as a", "node as b")
        members = texts_of(found.select("node").distinct(), "across").mapInArrow(_sets(shingle), "node long, members binary")
        brought = written(members, "across-sets").join(marks.select("node", "signature"), "node")
        placed = placed.drop("across", "down").join(found, ["bucket", "node"]).join(marks.select("node", "n_shingles"), "node")
        tiles = placed.groupBy("bucket").agg(F.expr("count_if(minor) as few"), F.expr("sum(if(minor, n_shingles, 0)) as fewer"), F.expr("count(1) as n"), F.expr("sum(n_shingles) as all"))
        tiles = tiles.selectExpr(
            "bucket", f"ceil(greatest(few / {_ROWS}, fewer / {_ROW_SHINGLES})) as across", f"ceil(greatest(n / {_COLUMNS}, all / {_COLUMN_SHINGLES})) as down"
        )
        links = in_tiles(placed.join(tiles, "bucket"), brought).select("bucket", "node", "component", "minor", "row", "first", "second", "signature", "members")
        return written(links.mapInArrow(_links(percent / 100, miss, percent), "a long, b long").distinct(), "across-links")

    def joined(classes: DataFrame, links: DataFrame) -> DataFrame:
        return components(classes.selectExpr("node as a", "component as b").union(links))

    stars = shared.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    whole = components(linked(likely(stars), "star"))
    while True:
        links = linked(likely(around_consensus(whole)), "consensus")
        if links.isEmpty():
            break
        whole = joined(whole, links)
    while True:
        links = linked(apart(whole), "best")
        if links.isEmpty():
            break
        whole = joined(whole, links)
    links = across(whole)
    whole = whole if links.isEmpty() else joined(whole, links)
    classes = named.join(whole, "node", "left").select(F.col("doc_id").alias("__id"), F.coalesce("component", "node").alias("__class"))
    out = sketches.select("doc_id", "n_shingles").join(classes, F.col("doc_id") == F.col("__id"), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("__class")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
