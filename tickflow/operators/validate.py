"""Decoding and checking of topic records."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.functions.fence import fence
from tickflow.functions.json_text import from_json, suspect_kinds, uint64_field, wrong_kind
from tickflow.functions.numbers import in_range
from tickflow.schemas import MAX_SECONDS, UINT32_MAX, UINT64_MAX

#: Event fields: kind and SQL type. The body stays JSON text until its type is known.
EVENT_FIELDS = {
    "epoch": ("int", "BIGINT"),
    "tickNumber": ("u64", "BIGINT"),
    "index": ("u64", "BIGINT"),
    "type": ("int", "BIGINT"),
    "logId": ("u64", "BIGINT"),
    "logDigest": ("str", "STRING"),
    "transactionHash": ("str", "STRING"),
    "timestamp": ("u64", "BIGINT"),
    "bodySize": ("int", "BIGINT"),
    "body": ("obj", "STRING"),
    "dividend": ("bool", "BOOLEAN"),
    "lastLogForTick": ("bool", "BOOLEAN"),
}
#: Required fields in the order in which they are reported.
REQUIRED = ["epoch", "tickNumber", "logId", "timestamp", "logDigest", "index", "type"]
#: Ranges of the integer fields.
_RANGES = {
    "epoch": (0, UINT32_MAX),
    "tickNumber": (0, UINT64_MAX),
    "index": (0, UINT64_MAX),
    "type": (-32768, 32767),
    "logId": (0, UINT64_MAX),
    "timestamp": (0, UINT64_MAX),
    "bodySize": (0, UINT32_MAX),
}
#: Fields that must not be zero or empty (a log id of 0 is fine), in report order.
NONZERO = ["epoch", "tickNumber", "logDigest", "timestamp"]


def decode_event(records: DataFrame, value: str = "value") -> DataFrame:
    """Topic JSON -> nullable event columns plus ``decode_error``; other columns are kept.

    NULL means absent or JSON null. A value of the wrong JSON type or out of
    range, or text that is no JSON object, sets ``decode_error``.
    """
    kinds = {name: kind for name, (kind, _) in EVENT_FIELDS.items()}
    parsed = from_json(value, {name: sql for name, (_, sql) in EVENT_FIELDS.items()})
    every = {"true": list(EVENT_FIELDS)}
    kept = [f"`{c}`" for c in records.columns if c not in EVENT_FIELDS]
    rows = (
        records.withColumn("__j", F.expr(parsed))
        .withColumn("__kinds", F.expr(suspect_kinds(value, "__j", kinds, every)))
        .selectExpr(
            *dict.fromkeys([*kept, f"`{value}`"]),
            *[
                (uint64_field(value, "__j", "__kinds", name) if kind == "u64" else f"__j.`{name}`") + f" `{name}`"
                for name, (kind, _) in EVENT_FIELDS.items()
            ],
            "__kinds",
        )
    )
    beyond = " ".join(f"when not {in_range(f'`{name}`', *bounds)} then '{name}'" for name, bounds in _RANGES.items())
    error = (
        f"case when {value} is null or not endswith(trim(trailing ' \t\r\n' from {value}), '}}') then 'json'"
        f" else coalesce({wrong_kind('__kinds', kinds, every, 'json')}, case {beyond} end) end"
    )
    return rows.selectExpr(*kept, *[f"`{name}`" for name in EVENT_FIELDS], f"{fence(error)} decode_error")


def _names(conditions: dict[str, str]) -> str:
    """Comma-separated names whose condition is true, NULL if there are none."""
    flags = ", ".join(f"case when {condition} then '{name}' end" for name, condition in conditions.items())
    return f"nullif(concat_ws(',', {flags}), '')"


def validate_required(events: DataFrame) -> DataFrame:
    """Add ``missing``: names of absent required fields."""
    return events.withColumn("missing", F.expr(_names({c: f"`{c}` is null" for c in REQUIRED})))


def validate_nonzero(events: DataFrame) -> DataFrame:
    """Add ``zero``: names of fields that are present but zero or empty."""
    zeros = {c: f"`{c}` = ''" if c == "logDigest" else f"`{c}` = 0" for c in NONZERO}
    return events.withColumn("zero", F.expr(_names(zeros)))


def apply_defaults(events: DataFrame) -> DataFrame:
    """Absent optional fields: empty hash, size 0, flags false; an absent body stays absent."""
    defaults = {"transactionHash": "''", "bodySize": "0", "dividend": "false", "lastLogForTick": "false"}
    return events.selectExpr(
        *[f"coalesce(`{c}`, {defaults[c]}) `{c}`" if c in defaults else f"`{c}`" for c in events.columns]
    )


def to_millis(seconds: str) -> str:
    """Seconds -> milliseconds; NULL beyond the year 2286 (the value is in milliseconds already)."""
    return f"case when {seconds} <= {MAX_SECONDS} then cast({seconds} as bigint) * 1000 end"


def parse_supported(text: str) -> list[int]:
    """Supported types from ``{"0":[...]}``. Without key 0, or from null, nothing is supported."""
    parsed = json.loads(text)
    if parsed is None:
        return []
    if not isinstance(parsed, dict):
        raise ValueError("supported types must be a JSON object")
    types = parsed.get("0") or []
    if not all(isinstance(t, int) and not isinstance(t, bool) and -32768 <= t <= 32767 for t in types):
        raise ValueError("supported types must be 16-bit integers")
    return types


class BadRecords(RuntimeError):
    """A strict job met records that cannot be processed; nothing of the batch was written."""


def error_policy(routed: DataFrame, mode: str) -> None:
    """In strict mode raise if any record failed, naming one reason; quarantine mode lets them pass."""
    if mode not in ("strict", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "strict":
        failed = routed.filter(F.col("status") == "failed").select("reason").take(1)
        if failed:
            raise BadRecords(failed[0]["reason"])
