"""Mixing sources to target weights by pivotal dependent rounding; DataFrame and SQL functions only.

A source's target is its weight's share of all words, stopped at ``cap`` times its
own words, the excess reshared. Each document of it is due target / source words
copies. The whole part is certain. The fractions are rounded dependently: two
documents trade words, up or down at random so that the expected copies of both
stay what they are, until one of them has a whole number; the other one goes on
as the residual. So the words of a source stay what they were, but for one residual at the end.

Documents are dealt by a hash to buckets of about ``bucket`` rows of a source; a
bucket hands one residual to the next level, where ``bucket`` buckets meet, and so
on until one bucket is left: a reduction tree of log(rows) levels, in which
no task ever holds more than some buckets. The last residual of a source is rounded down,
and what is then missing is made up by up to
``closing`` single documents of fitting size, which switch between the two copy
counts they might have had.

Chance comes from hashes of ids and the seed: reruns agree. Null is a source of its
own, the last one. Documents without words (null or blank text) are never taken.
Rows equal in id, source and size are a unit: of those that are due a fraction each, as many as they are due together are taken for
certain, and the rest of less than one row is rounded by chance.
With no words at all every target is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import WORD, written

_STATE = "struct<id: bigint, size: bigint, whole: int, p: double>"
_DONE = "array<struct<id: bigint, size: bigint, copies: int>>"


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` (one row per ``source``) with ``rank`` from 0 by code point, null last, without a one-task sort."""
    parts = sources.sparkSession.conf.get("spark.sql.shuffle.partitions")
    order = [F.col("source").isNull(), F.col("source")]
    placed = written(sources.repartitionByRange(int(parts), *order).withColumn("part", F.spark_partition_id()), "sources")
    inside = placed.selectExpr("*", "row_number() over (partition by part order by source is null, source) - 1 as inside")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row per partition.
    before = sizes.selectExpr("part as __part", "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0) as before")
    return inside.join(before, F.col("part") == F.col("__part")).withColumn("rank", F.col("inside") + F.col("before")).drop("part", "__part", "inside", "before")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """(source, source_size) -> also ``target``."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = written(ranked(sizes).withColumn("weight", weight), "weighed").withColumn("most", F.col("source_size") * F.lit(float(cap)))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    # Water level per unit of weight: rises as sources stop at their cap, until no other one is above its cap.
    level, stopped = 0.0, -1
    while total:
        over = F.col("most") <= F.col("weight") * level
        full, n, free = weighed.agg(
            F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)), F.count_if(over), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))
        ).first()
        if n == stopped or not free:
            break
        level, stopped = (total - full) / free, n
    return weighed.select("source", "source_size", F.least("most", F.col("weight") * level).alias("target"))


def _trade(seed: int):
    """One step of a bucket: the held residual and the next document trade words until one is whole."""

    def step(held: Column, new: Column) -> Column:
        a, b = held["one"], new
        wa, wb = a["size"].cast("double"), b["size"].cast("double")
        rise = F.least((1 - a["p"]) * wa, b["p"] * wb)  # words that can go from b to a
        fall = F.least(a["p"] * wa, (1 - b["p"]) * wb)
        luck = F.pmod(F.xxhash64(F.lit(seed), a["id"], b["id"], a["size"], b["size"]), F.lit(1 << 30)) / float(1 << 30)
        up = luck * (rise + fall) < fall
        moved = F.when(up, rise).otherwise(-fall)
        snap = lambda p: F.when(p < 1e-9, 0.0).when(p > 1 - 1e-9, 1.0).otherwise(p)
        a_stops = F.when(up, (1 - a["p"]) * wa <= b["p"] * wb).otherwise(a["p"] * wa <= (1 - b["p"]) * wb)
        pa = F.when(a_stops, F.when(up, 1.0).otherwise(0.0)).otherwise(snap(a["p"] + moved / wa))
        pb = F.when(a_stops, snap(b["p"] - moved / wb)).otherwise(F.when(up, 0.0).otherwise(1.0))
        is_whole = lambda p: (p == 0.0) | (p == 1.0)
        # The state after the trade, so that what follows is not computed again and again.
        after = F.array(F.struct(pa.alias("pa"), pb.alias("pb")))
        settled = lambda x, p: F.struct(x["id"].alias("id"), x["size"].alias("size"), (x["whole"] + p.cast("int")).alias("copies"))
        going = lambda x, p: F.struct(x["id"].alias("id"), x["size"].alias("size"), x["whole"].alias("whole"), p.alias("p"))
        out = F.transform(
            after,
            lambda t: F.struct(
                F.when(~is_whole(t["pa"]), going(a, t["pa"])).when(~is_whole(t["pb"]), going(b, t["pb"])).alias("one"),
                F.concat(
                    held["done"],
                    F.when(is_whole(t["pa"]), F.array(settled(a, t["pa"]))).otherwise(F.expr(f"cast(array() as {_DONE})")),
                    F.when(is_whole(t["pb"]), F.array(settled(b, t["pb"]))).otherwise(F.expr(f"cast(array() as {_DONE})")),
                ).alias("done"),
            ),
        )[0]
        return F.when(a.isNull(), F.struct(going(b, b["p"]).alias("one"), held["done"].alias("done"))).otherwise(out).cast(f"struct<one: {_STATE}, done: {_DONE}>")

    return step


def pivotal(rows: DataFrame, seed: int = 17, bucket: int = 64) -> DataFrame:
    """(source, id, size > 0, whole int, 0 <= p < 1) -> (source, id, size, copies); p is 0 or 1 in the end but for
    one residual of a source, which is rounded down."""
    certain = rows.filter("p = 0").select("source", "id", "size", F.col("whole").alias("copies"))
    going = rows.filter("p > 0")
    n = going.count()
    buckets = max(1, -(-n // bucket))
    going = going.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "id", "size"), F.lit(buckets)))
    parts = [certain]
    start = F.expr(f"cast(named_struct('one', null, 'done', array()) as struct<one: {_STATE}, done: {_DONE}>)")
    while True:
        # Large documents first; a bucket has about ``bucket`` rows of all sources together.
        items = F.sort_array(F.collect_list(F.struct(F.col("size"), "id", "whole", "p")), asc=False)
        met = going.groupBy("source", "bucket").agg(items.alias("items"))
        met = written(met.select("source", "bucket", F.aggregate("items", start, _trade(seed)).alias("s")), "rounded")
        parts.append(met.select("source", F.inline("s.done")).select("source", "id", "size", "copies"))
        going = met.filter("s.one is not null").select("source", "bucket", "s.one.*")
        if buckets == 1:
            break
        buckets = -(-buckets // bucket)
        going = going.withColumn("bucket", F.floor(F.col("bucket") / bucket))
    parts.append(going.select("source", "id", "size", F.col("whole").alias("copies")))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: int = 17, closing: int = 4) -> DataFrame:
    """(doc_id, text, source) -> doc_id, source, size, source_size, target, copies; a row for every row of ``docs``."""
    plan = _plan(docs, weights, cap, seed, closing)
    some = plan.filter("rows > 1").withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(rows - 1) div {_ROWS_AT_ONCE}"))))
    # Rows of a unit that stands there very often are made in many tasks, some thousand by each.
    some = some.repartition("id", "source", "size", "step")
    some = some.withColumn("nth", F.explode(F.expr(f"sequence(step * {_ROWS_AT_ONCE}, least(rows, (step + 1) * {_ROWS_AT_ONCE}) - 1)")))
    rows = plan.filter("rows = 1").withColumn("nth", F.lit(0).cast("long")).unionByName(some.drop("step"))
    return rows.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", _copies().alias("copies"))


#: Rows of a unit that one task makes.
_ROWS_AT_ONCE = 4096


def _copies() -> Column:
    """Copies of the nth row (from 0) of a unit."""
    return (F.col("whole") + (F.col("nth") < F.col("more")).cast("int")).cast("int")


def _plan(docs: DataFrame, weights: tuple[int, ...], cap: int, seed: int, closing: int) -> DataFrame:
    """One row per unit (id, source, size) with its number of ``rows``: each is taken ``whole`` times, ``more`` of them once more.

    Of rows due 0.3 copies each, ten are due 3 copies together: three rows are taken for certain. Only what is left below one row is
    rounded by chance, as one row of that fraction.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("id"), "source", word_count("text").alias("size"))
    units = written(sized.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "units")
    goals = written(targets(units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size")), weights, cap), "targets")
    goal = goals.withColumnRenamed("source", "__source")
    due = units.join(goal, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # A rate that is whole but for rounding is whole.
    rate = F.when(F.abs(rate - F.round(rate)) < 1e-12, F.round(rate)).otherwise(rate)
    due = due.withColumn("rate", rate).withColumn("whole", F.when(F.col("size") > 0, F.floor("rate")).otherwise(0).cast("int"))
    due = due.withColumn("share", F.when(F.col("size") > 0, (F.col("rate") - F.col("whole")) * F.col("rows")).otherwise(0.0))
    due = due.withColumn("sure", F.floor("share"))
    worded = due.filter("size > 0").select("source", "id", "size", F.lit(0).alias("whole"), (F.col("share") - F.col("sure")).alias("p"))
    copies = written(pivotal(worded, seed), "copies")
    # Words that are taken for certain, and whether chance has a say in a source.
    certain = due.groupBy("source").agg(F.sum(F.expr("size * (rows * whole + sure)")).alias("certain"), F.max("target").alias("target"), F.max(F.expr("rate > floor(rate)")).alias("open"))
    certain = written(certain, "certain").withColumnRenamed("source", "__source")
    for _ in range(closing):
        taken = copies.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"))
        off = taken.join(certain, F.col("source").eqNullSafe(F.col("__source"))).filter("open")
        off = off.select("__source", (F.col("certain") + F.col("taken") - F.col("target")).alias("off"))
        # A document that can switch and leaves less of the gap than any other.
        can = copies.join(off, F.col("source").eqNullSafe(F.col("__source"))).filter(F.when(F.col("off") > 0, F.col("copies") > 0).otherwise(F.col("copies") == 0))
        left = F.abs(F.abs("off") - F.col("size"))
        best = can.filter(left < F.abs("off")).groupBy("source").agg(F.min(F.struct(left.alias("left"), "id", "size")).alias("b"), F.first("off").alias("off"))
        best = best.select(F.col("source").alias("__source"), F.col("b.id").alias("__id"), F.col("b.size").alias("__size"), F.signum("off").cast("int").alias("by"))
        same = F.col("source").eqNullSafe(F.col("__source")) & F.col("id").eqNullSafe(F.col("__id")) & (F.col("size") == F.col("__size"))
        copies = written(
            copies.join(best, same, "left").select("source", "id", "size", (F.col("copies") - F.coalesce("by", F.lit(0))).alias("copies")), "copies"
        )
    made = copies.select(F.col("source").alias("__source"), F.col("id").alias("__id"), F.col("size").alias("__size"), "copies")
    same = F.col("source").eqNullSafe(F.col("__source")) & F.col("id").eqNullSafe(F.col("__id")) & (F.col("size") == F.col("__size"))
    out = due.join(made, same, "left").withColumn("more", F.col("sure") + F.coalesce("copies", F.lit(0)))
    return out.select("id", "source", "size", "rows", "source_size", "target", "whole", "more")


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``nth``, a number from 0 among the rows with equal ``keys``, though no task sees all of these: rows are numbered inside
    the partition they lie in, and one row per key and partition says what lies before. Keys have no nulls."""
    placed = written(rows.withColumn("__part", F.spark_partition_id()).withColumn("__place", F.monotonically_increasing_id()), "placed")
    by = ", ".join(keys)
    inside = placed.selectExpr("*", f"row_number() over (partition by {by}, __part order by __place) - 1 as __inside")
    counts = placed.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.selectExpr(*keys, "__part", f"sum(n) over (partition by {by} order by __part) - n as __before")
    return inside.join(before, [*keys, "__part"]).withColumn("nth", F.col("__inside") + F.col("__before")).drop("__part", "__place", "__inside", "__before")


def repeated(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: int = 17, closing: int = 4) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies say, not at all for none."""
    plan = _plan(docs, weights, cap, seed, closing).filter("whole > 0 or more > 0")
    # A key without nulls: JSON leaves them out.
    plan = written(plan.select(F.to_json(F.struct("id", "source", "size")).alias("__unit"), "rows", "whole", "more"), "plan")
    unit = F.to_json(F.struct(F.col("doc_id").cast("long").alias("id"), F.col("source").alias("source"), word_count("text").alias("size")))
    joined = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), unit.alias("__unit")).join(plan, "__unit")
    even = joined.filter("more = 0 or more = rows").withColumn("nth", F.lit(0).cast("long"))
    # Which of a unit's rows are taken once more matters only where not all or none are.
    uneven = numbered(joined.filter("more > 0 and more < rows"), ["__unit"])
    copies = even.unionByName(uneven).withColumn("__copies", _copies()).filter("__copies > 0")
    return copies.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("__row.*")
