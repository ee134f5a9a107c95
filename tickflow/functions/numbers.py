"""Checked conversions of JSON numbers (doubles) to integer types.

Each function is NULL where the value has no exact counterpart in the target
type. Unsigned 64-bit values are DECIMAL(20,0).
"""

from __future__ import annotations

from tickflow.schemas import UINT32_MAX

_TWO_63 = "9223372036854775808D"
_TWO_64 = "18446744073709551616D"


def to_uint64(x: str) -> str:
    """Whole numbers in [0, 2^64). Goes through BIGINT halves, so no digit is rounded."""
    return (
        f"case when {x} >= 0 and {x} < {_TWO_63} and {x} = floor({x})"
        f" then cast(try_cast({x} as bigint) as decimal(20,0))"
        f" when {x} >= {_TWO_63} and {x} < {_TWO_64}"
        f" then cast(try_cast({x} - {_TWO_63} as bigint) + 9223372036854775808 as decimal(20,0)) end"
    )


def to_int64(x: str) -> str:
    """Whole numbers in [-2^63, 2^63)."""
    return f"case when {x} >= -{_TWO_63} and {x} < {_TWO_63} and {x} = floor({x}) then try_cast({x} as bigint) end"


def _bounded(x: str, top: int, kind: str) -> str:
    return f"case when {x} between 0 and {top} and {x} = floor({x}) then try_cast({x} as {kind}) end"


def to_uint32(x: str) -> str:
    return _bounded(x, UINT32_MAX, "bigint")


def to_positive_int16(x: str) -> str:
    return _bounded(x, 32767, "smallint")


def to_byte(x: str) -> str:
    """0..255; a fraction is cut off, not rejected."""
    return f"case when {x} between 0 and 255 then try_cast(floor({x}) as smallint) end"


def in_range(x: str, low: int, high: int) -> str:
    """Range test; SQL literals beyond 64 bits are decimals."""
    return f"{x} between {low} and {high}"
