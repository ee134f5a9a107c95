"""Carrying totals and states forward over ordered data, without one task per group.

A running value inside a group is split in three: rows are numbered inside
chunks (a window over a bounded range of the order key), each chunk is reduced
to one row by a map-side combined aggregate, and only those chunk rows are
scanned across the group, in two levels. A group that holds a third of all
rows is spread over as many tasks as it has chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Chunk rows per first-level block.
BLOCK_BITS = 14

_BEFORE = "rows between unbounded preceding and 1 preceding"


def carry_forward(chunks: DataFrame, keys: list[str], seq: str, sums: list[str], lasts: list[str]) -> DataFrame:
    """What lies before each chunk of its group.

    ``chunks`` has one row per ``keys`` + ``seq``, none of them null. Returns
    those columns plus ``before_<c>``: the sum of every column of ``sums`` and
    the latest non-null value of every column of ``lasts`` over the earlier chunks.
    """
    by_key = f"partition by {', '.join(keys)}" if keys else ""
    within = f"over (partition by {', '.join([*keys, '__block'])} order by {seq} {_BEFORE})"
    across = f"over ({by_key} order by __block {_BEFORE})"
    # The null tests are spelled out here so that the join below adds none to one of its sides only:
    # both sides stay equal down to the scan, and the chunks are computed once.
    blocks = chunks.selectExpr("*", f"shiftright({seq}, {BLOCK_BITS}) __block").filter(
        " and ".join(f"{c} is not null" for c in [*keys, seq, "__block"])
    )
    inner = blocks.selectExpr(
        *keys,
        seq,
        "__block",
        *[f"coalesce(sum({c}) {within}, 0) __in_{c}" for c in sums],
        *[f"last({c}, true) {within} __in_{c}" for c in lasts],
    )
    totals = [f"sum({c}) {c}" for c in sums] + [f"max_by({c}, case when {c} is not null then {seq} end) {c}" for c in lasts]
    outer = (
        blocks.groupBy(*keys, "__block")
        .agg(*[F.expr(t) for t in totals])
        .selectExpr(
            *keys,
            "__block",
            *[f"coalesce(sum({c}) {across}, 0) __out_{c}" for c in sums],
            *[f"last({c}, true) {across} __out_{c}" for c in lasts],
        )
    )
    return inner.join(outer, [*keys, "__block"]).selectExpr(
        *keys,
        seq,
        *[f"__in_{c} + __out_{c} before_{c}" for c in sums],
        *[f"coalesce(__in_{c}, __out_{c}) before_{c}" for c in lasts],
    )
