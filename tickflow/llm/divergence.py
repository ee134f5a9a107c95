"""Source divergence audit: how the words of a source differ from its language's, and from the other sources'.

Terms are runs of letters (A-Z in lower case, and everything beyond ASCII). A language keeps the terms that
``least_docs`` of its documents hold. A group's (or language's) share of a kept term is smoothed and rounded to
a billionth, ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``; two shares diverge by ``floor((p - q)^2 / (p + q))``. All is
integer arithmetic.

* Term part, by a dominance skyband. Where p > q the divergence rises with the group's count and falls with the
  language's, so a term that ``top`` others beat in both counts and in UTF-8 order cannot be among the first ``top``. Each
  partition keeps of every group only the terms that fewer than ``top`` others dominate; skybands are merged,
  ``fan_in`` partitions at a time, each merge again a skyband, and what is left is ranked exactly.
* Pair part: for every two sources of a language the sum over all kept terms. Cells go to tiles of some
  ``tile_terms`` terms by some ``tile_sources`` sources, with one row for each source's share of a term it does not have
  and the number of terms; a tile is summed in numpy, one row per pair leaves it. The result has a row for every pair, the work is no larger than
  terms times pairs, and no task holds more than a tile.

Counting: each task counts its own documents in dictionaries that it empties at ``held`` terms, so one row per group and
term and task is shuffled, however frequent a term or source is.

Null text, lang and source count as ''. Repeated rows count as often as they stand there; ids are not looked at.
A group without kept terms has pair rows only, a language with one source has no pairs, an empty table gives no rows.
Columns other than ``text``, ``lang`` and ``source`` are not looked at, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import runs, written

#: Bytes that are no part of a term become spaces, A-Z become a-z.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_BLOCK = 1024


def terms(text: str) -> list[bytes]:
    """The terms of a text in their order, in UTF-8."""
    return text.encode().translate(_TERM_BYTES).split()


def _counter(held: int):
    """Rows (lang, source, term, n, docs); a null term says that the group is there."""

    def rows(groups: dict) -> pa.RecordBatch:
        langs, sources, names, n, docs = [], [], [], [], []
        for (lang, source), (count, holders) in groups.items():
            langs += [lang] * (len(count) + 1)
            sources += [source] * (len(count) + 1)
            names += [None, *count]
            n += [0, *count.values()]
            docs += [0, *map(holders.__getitem__, count)]
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(names, pa.binary()).view(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
            ["lang", "source", "term", "n", "docs"],
        )

    def count(batches):
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
                n, docs = groups.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                before = len(n)
                found = terms(text.as_py())
                n.update(found)
                docs.update(set(found))
                size += len(n) - before
                if size >= held:
                    yield rows(groups)
                    groups, size = {}, 0
        yield rows(groups)

    return count


def skyband(n: np.ndarray, total: np.ndarray, k: int) -> np.ndarray:
    """Which rows fewer than ``k`` others dominate: n no smaller, total no larger, and an earlier row.

    All dominators of a row precede it in the order (n down, total up, row), and a row with ``k`` of them has ``k``
    inside the skyband; so a block of rows is held against the kept ones, and then against itself.
    """
    order = np.lexsort((np.arange(len(n)), total, -n))
    kept = np.empty(0, np.int64)
    for start in range(0, len(order), _BLOCK):
        block = order[start : start + _BLOCK]
        by = np.zeros(len(block), np.int64)
        for at in range(0, len(kept), 8 * _BLOCK):
            some = kept[at : at + 8 * _BLOCK]
            by += ((total[some] <= total[block][:, None]) & (some < block[:, None])).sum(axis=1)
        block, by = block[by < k], by[by < k]
        among = np.tril((total[block] <= total[block][:, None]) & (block < block[:, None]), -1)
        kept = np.concatenate([kept, block[by + among.sum(axis=1) < k]])
    return np.sort(kept)


def _skybands(k: int, keys: list[str]):
    """Of a partition sorted by ``keys`` and term, each group's skyband."""

    def keep(batches):
        for group in runs(batches, keys):
            kept = skyband(group.column("n").to_numpy(), group.column("total").to_numpy(), k)
            yield from group.take(pa.array(kept)).combine_chunks().to_batches()

    return keep


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _tile_sums(batches):
    """Sums of divergences of the pairs of a tile: of two sources in one block, or of two that lie in its two blocks."""
    for tile in runs(batches, ["lang", "part", "one", "two"]):
        sources = tile.column("source").combine_chunks().dictionary_encode()
        names, of = sources.dictionary, sources.indices.to_numpy()
        named = tile.column("term").combine_chunks().dictionary_encode()
        p, block = tile.column("p").to_numpy(), tile.column("block").to_numpy()
        real = tile.column("term").is_valid().combine_chunks().to_numpy(zero_copy_only=False)
        absent, own = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        absent[of[~real]], own[of] = p[~real], block
        shares = np.tile(absent, (len(named.dictionary), 1))
        shares[named.indices.filter(pa.array(real)).to_numpy().astype(np.int64), of[real]] = p[real]
        # Kept terms of this part that no source of the tile has.
        unseen = pc.max(tile.column("terms")).as_py() - len(named.dictionary)
        across = tile.column("one")[0].as_py() != tile.column("two")[0].as_py()
        for i in range(len(names)):
            others = np.flatnonzero(own > own[i]) if across else np.arange(i + 1, len(names))
            if len(others):
                sums = _apart(shares[:, [i]], shares[:, others]).sum(axis=0) + unseen * _apart(absent[i], absent[others])
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(tile.column("lang")[0], len(others)), pa.repeat(names[i], len(others)), names.take(pa.array(others)), pa.array(sums)],
                    ["lang", "source", "item", "value"],
                )


def divergence(docs: DataFrame, least_docs: int = 10, top: int = 10, tile_terms: int = 2048, tile_sources: int = 64, fan_in: int = 32, held: int = 500_000) -> DataFrame:
    """(text, lang, source) -> lang, source, part (``pair`` or ``term``), item, value, rank from 1."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    seen = texts.mapInArrow(_counter(held), "lang string, source string, term string, n long, docs long")
    seen = seen.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    seen = written(seen, "term-counts")
    kept = seen.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = written(kept.filter(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    cells = written(seen.drop("docs").join(kept, ["lang", "term"]), "cells")

    # One row per language and per group.
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    groups = seen.filter("term is null").select("lang", "source")
    group_n = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    counts = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    groups = groups.join(group_n, ["lang", "source"], "left").join(sizes, "lang", "left").join(counts, "lang").na.fill(0)
    groups = written(groups, "groups")

    def share(count: str, size: str) -> F.Column:
        """One billionth is the unit; counts may exceed what a long holds times that."""
        return F.expr(f"cast(1 + (cast(1000000000 as decimal(38,0)) * ({count} + 2)) div greatest({size} + 2 * v, 1) as bigint)")

    cells = cells.join(groups, ["lang", "source"]).withColumn("p", share("n", "group_n"))
    risen = cells.withColumn("q", share("total", "lang_n")).filter("p > q")
    parts = risen.select("lang", "source", "term", "n", "total", "p", "q", F.spark_partition_id().alias("part"))
    first = parts.sortWithinPartitions("part", "lang", "source", "term")
    best = first.mapInArrow(_skybands(top, ["lang", "source"]), parts.schema)
    best = written(best, "skybands")
    n = best.agg(F.max("part")).first()[0] or 0
    while n:
        n //= fan_in
        best = best.withColumn("part", F.expr(f"part div {fan_in}").cast("int")).repartition("lang", "source", "part")
        best = best.sortWithinPartitions("lang", "source", "part", "term").mapInArrow(_skybands(top, ["lang", "source", "part"]), parts.schema)
    value = F.expr("(p - q) * (p - q) div (p + q)")
    found = best.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))

    tiled = groups.selectExpr("*", f"cast(greatest(ceil(v / {tile_terms}), 1) as int) parts", f"cast(ceil(sources / {tile_sources}) as int) blocks")
    tiled = tiled.withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    of_tile = ["lang", "source", "term", "p", "terms", "part", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")]
    absent = tiled.select("lang", "source", F.lit(None).cast("string").alias("term"), share("0", "group_n").alias("p"), "block", "blocks", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    present = cells.select("lang", "source", "term", "p").join(tiled.select("lang", "source", "parts", "block", "blocks"), ["lang", "source"])
    part = F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part")
    present = present.select("lang", "source", "term", "p", "block", "blocks", part, F.lit(0).cast("long").alias("terms"))
    in_part = kept.join(tiled.select("lang", "parts").distinct(), "lang").groupBy("lang", part).agg(F.count(F.lit(1)).alias("terms"))
    absent = absent.join(in_part, ["lang", "part"], "left").na.fill(0, ["terms"])
    tiles = absent.unionByName(present).select("*", met).select(*of_tile).repartition("lang", "part", "one", "two")
    tiles = tiles.sortWithinPartitions("lang", "part", "one", "two")
    pairs = tiles.mapInArrow(_tile_sums, "lang string, source string, item string, value long")
    # Tiles name the two sources of a pair in any order.
    pairs = pairs.select("lang", F.least("source", "item").alias("source"), F.greatest("source", "item").alias("item"), "value")
    pairs = written(pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pairs")
    both = pairs.unionByName(pairs.selectExpr("lang", "item as source", "source as item", "value"))

    def ranked(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.expr("row_number() over (partition by lang, source order by value desc, item)"))

    both = ranked(both.select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    return both.unionByName(ranked(found).filter(F.col("rank") <= top))
