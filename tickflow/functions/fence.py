"""Keeping a filter above the projection that computes its column."""

from __future__ import annotations


def fence(expression: str) -> str:
    """``expression`` unchanged, but never copied into a filter below.

    Catalyst pushes a filter through projections by putting the column's
    definition in its place. For a verdict built in several layers from a
    parsed JSON struct that would repeat the parsing once per mention. A
    projection with a part that is not deterministic is not passed; the
    partition id is such a part, and it is never negative.
    """
    return f"case when spark_partition_id() >= 0 then {expression} end"
