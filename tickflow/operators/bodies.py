"""Typed bodies: parse by type tag, canonical JSON, and the two key renames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tickflow.functions.fence import fence
from tickflow.functions.json_text import from_json, suspect_kinds, uint64_field, wrong_kind
from tickflow.functions.numbers import in_range
from tickflow.schemas import HEX_BODY, RENAMED_TYPES, SOURCE_BODIES, TYPE_NAMES, UINT32_MAX, UINT64_MAX

_ZEROS = {"str": "''", "u64": "cast(0 as decimal(20,0))"}
#: Kinds that are narrower than the column they are read into.
_BOUNDS = {
    "i32": (-(2**31), 2**31 - 1),
    "u32": (0, UINT32_MAX),
    "u64": (0, UINT64_MAX),
}


def _carriers() -> dict[str, tuple[str, list[int]]]:
    """Source key -> (kind, types that carry it), keys sorted. A key has one kind wherever it occurs."""
    out: dict[str, tuple[str, list[int]]] = {}
    for code, fields in SOURCE_BODIES.items():
        for field in fields:
            out.setdefault(field.key, (field.kind, []))[1].append(code)
    return dict(sorted(out.items()))


_HEX_TYPES = [t for t, fields in SOURCE_BODIES.items() if fields is HEX_BODY]


def _is_type(types: list[int]) -> str:
    """SQL test of the type; types without a body table carry the hex body."""
    if types == _HEX_TYPES:
        return f"type not in ({', '.join(str(t) for t in TYPE_NAMES if t not in types)})"
    return f"type in ({', '.join(map(str, types))})"


def body_text(df: DataFrame, column: str = "body") -> Column:
    """The body column as JSON text, whether it is text already or a VARIANT."""
    return F.col(column) if isinstance(df.schema[column].dataType, StringType) else F.to_json(F.col(column))


def parse_body(df: DataFrame) -> DataFrame:
    """Add ``parsed`` (one struct over all source keys) and ``parse_error``.

    Of ``parsed`` only the keys of the row's type are set: absent or null
    keys get the zero value, other keys are dropped. An absent body gives a
    NULL struct, a JSON null an all-zero one. ``parse_error`` names the first
    key whose value does not fit, or ``body`` if the body is no object.
    """
    carriers = _carriers()
    kinds = {key: kind if kind in ("str", "u64") else "int" for key, (kind, _) in carriers.items()}
    by_type: dict[str, list[str]] = {}
    for code, fields in SOURCE_BODIES.items():
        if fields is not HEX_BODY:
            by_type[f"type = {code}"] = [f.key for f in fields]
    by_type["true"] = [f.key for f in HEX_BODY]

    sql_types = {key: "STRING" if kind == "str" else "BIGINT" for key, (kind, _) in carriers.items()}
    rows = (
        df.withColumn("__text", body_text(df))
        .withColumn("__j", F.expr(from_json("__text", sql_types)))
        .withColumn("__kinds", F.expr(suspect_kinds("__text", "__j", kinds, by_type)))
    )

    def value(key: str, kind: str) -> str:
        return uint64_field("__text", "__j", "__kinds", key) if kind == "u64" else f"__j.`{key}`"

    members = ", ".join(
        f"'{key}', case when {_is_type(types)} then coalesce({value(key, kind)}, {_ZEROS.get(kind, '0L')}) end"
        for key, (kind, types) in carriers.items()
    )
    beyond = " ".join(
        f"when {_is_type(types)} and not {in_range(value(key, kind), *_BOUNDS[kind])} then '{key}'"
        for key, (kind, types) in carriers.items()
        if kind in _BOUNDS
    )
    error = (
        "case when __text is null or __text = 'null' then null"
        f" else coalesce({wrong_kind('__kinds', kinds, by_type, 'body')}, case {beyond} end) end"
    )
    return rows.selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"case when __text is not null then named_struct({members}) end parsed",
        f"{fence(error)} parse_error",
    )


def source_body_json(parsed: str = "parsed") -> str:
    """Canonical JSON of a parsed body: keys sorted, only those of the type."""
    return f"to_json({parsed})"


def rename_body(parsed: str = "parsed") -> str:
    """Canonical JSON of a parsed body under its topic-side keys."""
    sources: dict[str, list[str]] = {}
    for fields in SOURCE_BODIES.values():
        for f in fields:
            if f.key not in sources.setdefault(f.topic_key, []):
                sources[f.topic_key].append(f.key)
    members = ", ".join(
        f"'{topic_key}', coalesce({', '.join(f'{parsed}.`{key}`' for key in keys)})"
        for topic_key, keys in sorted(sources.items())
    )
    return f"case when {parsed} is not null then to_json(named_struct({members})) end"


def rename_stored_body(df: DataFrame, type_column: str = "event_type") -> DataFrame:
    """Add ``topic_body`` (JSON text) and ``rename_error`` to stored events.

    Works on the stored map, not on typed fields: a key that is missing
    becomes a JSON null, an absent body stays absent, and a body of an
    unknown type is an error.
    """
    renamed = ", ".join(map(str, RENAMED_TYPES))
    known = ", ".join(map(str, TYPE_NAMES))
    groups: dict[tuple, list[int]] = {}
    for t in RENAMED_TYPES:
        groups.setdefault(tuple(sorted((f.topic_key, f.key) for f in SOURCE_BODIES[t])), []).append(t)
    branches = ""
    for pairs, types in groups.items():
        members = ", ".join(f"'{topic}', try_variant_get(__body, '$.{key}', 'variant')" for topic, key in pairs)
        branches += (
            f" when {type_column} in ({', '.join(map(str, types))})"
            f" then to_json(named_struct({members}), map('ignoreNullFields', 'false'))"
        )
    rows = df.withColumn("__body", F.expr(f"case when {type_column} in ({renamed}) then try_parse_json(body) end"))
    return rows.selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"case when body is null or {type_column} not in ({known}) then null{branches} else body end topic_body",
        f"case when body is not null and {type_column} not in ({known}) then 'unsupported type' end rename_error",
    )
