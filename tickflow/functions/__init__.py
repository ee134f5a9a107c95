"""Scalar functions as SQL text over SQL text.

``to_uint64("amount")`` is the text of an expression; ``F.expr`` makes it a
column. The operators build whole projections from field tables, and one text
per projection is both quicker to build and easier to read in a plan than
thousands of column objects. NULL always means: the value cannot be converted.
"""

from tickflow.functions.fence import fence
from tickflow.functions.identity import is_identity
from tickflow.functions.json_text import from_json, suspect_kinds, wrong_kind
from tickflow.functions.numbers import in_range, to_byte, to_int64, to_positive_int16, to_uint32, to_uint64
from tickflow.functions.text import (
    hex_to_binary,
    oracle_state,
    parse_uint64_text,
    parse_utc_millis,
    unit_of_measurement,
)
from tickflow.functions.tx_hash import dividend_marker, tx_category, type_name

__all__ = [
    "dividend_marker",
    "fence",
    "from_json",
    "hex_to_binary",
    "in_range",
    "is_identity",
    "oracle_state",
    "parse_uint64_text",
    "parse_utc_millis",
    "suspect_kinds",
    "to_byte",
    "to_int64",
    "to_positive_int16",
    "to_uint32",
    "to_uint64",
    "tx_category",
    "type_name",
    "unit_of_measurement",
    "wrong_kind",
]
