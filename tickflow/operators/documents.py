"""Wide documents from topic records, and the routing of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.functions.fence import fence
from tickflow.functions.identity import is_identity
from tickflow.functions.json_text import from_json, suspect_kinds, wrong_kind
from tickflow.functions.numbers import to_byte, to_int64, to_positive_int16, to_uint32, to_uint64
from tickflow.functions.text import (
    hex_to_binary,
    oracle_state,
    parse_uint64_text,
    parse_utc_millis,
    unit_of_measurement,
)
from tickflow.functions.tx_hash import tx_category
from tickflow.operators.validate import (
    apply_defaults,
    decode_event,
    to_millis,
    validate_nonzero,
    validate_required,
)
from tickflow.schemas import (
    DEFAULT_SUPPORTED_TYPES,
    DIVIDEND_CATEGORY,
    DOCUMENT_BODIES,
    DOCUMENT_COLUMNS,
    DOCUMENT_OPTIONAL,
    DocField,
)

#: Rule -> (JSON kind that is read, conversion of what was read).
_RULES = {
    "text": ("str", lambda x: x),
    "u64": ("num", to_uint64),
    "i64": ("num", to_int64),
    "u32": ("num", to_uint32),
    "i16": ("num", to_positive_int16),
    "byte": ("num", to_byte),
    "hex": ("str", hex_to_binary),
    "unit": ("str", unit_of_measurement),
    "state": ("str", oracle_state),
    "datetime": ("str", parse_utc_millis),
    "u64text": ("str", parse_uint64_text),
}


def supported(df: DataFrame, types: Sequence[int] = DEFAULT_SUPPORTED_TYPES) -> DataFrame:
    """Rows of supported types. Looks at the type only, so it can run before any body is parsed."""
    return df.filter(F.col("type").isin(list(types)))


def nonzero_amount(documents: DataFrame) -> DataFrame:
    """Documents without transfers and burns of amount zero."""
    return documents.filter(~zero_amount())


def zero_amount() -> Column:
    return F.coalesce(F.col("logType").isin(0, 8) & (F.col("amount") == 0), F.lit(False))


def categories(category: str, dividend: str) -> str:
    """Hash category, then the dividend category; NULL instead of an empty array."""
    found = (
        f"array_compact(array(cast({category} as smallint),"
        f" case when {dividend} then cast({DIVIDEND_CATEGORY} as smallint) end))"
    )
    return f"case when {category} is not null or {dividend} then {found} end"


def _field_sources() -> dict[str, dict[DocField, list[int]]]:
    """Every document field with the topic keys it is read from and their types."""
    out: dict[str, dict[DocField, list[int]]] = {name: {} for name in DOCUMENT_OPTIONAL}
    for code, fields in DOCUMENT_BODIES.items():
        for field in fields:
            out[field.name].setdefault(field, []).append(code)
    return out


def _among(types: Sequence[int]) -> str:
    return f"in ({', '.join(map(str, types))})"


def _per_type(branches: dict[tuple[int, ...], str]) -> str:
    whens = " ".join(f"when logType {_among(types)} then {value}" for types, value in branches.items())
    return f"case {whens} end"


def to_document(events: DataFrame, keep: Sequence[str] = (), judged: str = "true") -> DataFrame:
    """Validated event columns -> document columns plus ``doc_error`` (and the ``keep`` columns).

    Bodies and hashes of rows that are not ``judged`` (SQL) are not looked into; their ``doc_error`` says nothing.

    ``doc_error`` names the first thing that is wrong, in this order: the
    timestamp, a zero value, the transaction hash, the type, a body field.
    Every body is parsed once, into one struct over all topic keys; a NULL
    among the fields of a type is the error of that field.
    """
    sources = _field_sources()
    kinds = {f.key: _RULES[f.rule][0] for fields in DOCUMENT_BODIES.values() for f in fields}
    sql_types = {key: "STRING" if kind == "str" else "DOUBLE" for key, kind in kinds.items()}
    texts = {
        f"logType = {t}": [f.key for f in fields if kinds[f.key] == "str"]
        for t, fields in DOCUMENT_BODIES.items()
        if any(kinds[f.key] == "str" for f in fields)
    }
    carried = [f"`{c}`" for c in keep]
    common = ["epoch", "tickNumber", "timestamp", "transactionHash", "logId", "logDigest", "logType"]

    named = events.withColumnRenamed("type", "logType")
    if judged != "true":
        named = named.withColumn("body", F.expr(f"case when {judged} then body end"))
    parsed = named.select(
        *[c.strip("`") for c in carried],
        *common,
        "dividend",
        "body",
        F.expr(from_json("body", sql_types)).alias("__j"),
        is_identity(F.expr(f"case when {judged} then transactionHash end") if judged != "true" else F.col("transactionHash")).alias("__identity"),
        F.expr(tx_category("transactionHash")).alias("__category"),
    )
    # Read, then convert: a conversion names its input several times.
    read = parsed.selectExpr(
        *carried,
        *common,
        "dividend",
        "__identity",
        "case when not __identity then __category end __category",
        # A number where a text is due reads as text; everything else that does not fit is NULL already.
        suspect_kinds("body", "__j", kinds, texts) + " __kinds",
        *[
            _per_type({tuple(types): f"__j.`{field.key}`" for field, types in fields.items()}) + f" `{name}`"
            for name, fields in sources.items()
        ],
    )
    converted = {
        "timestamp": to_millis("timestamp"),
        "transactionHash": "case when __category is null then transactionHash end",
        "categories": categories("__category", "dividend"),
    }
    for name, fields in sources.items():
        (rule,) = {field.rule for field in fields}
        converted[name] = _RULES[rule][1](f"`{name}`")
    flat = read.selectExpr(
        *carried,
        *[f"{converted.get(c, f'`{c}`')} `{c}`" for c in DOCUMENT_COLUMNS],
        "transactionHash = '' or __identity or __category is not null __hash_ok",
        f"{wrong_kind('__kinds', kinds, texts, 'body')} __misfit",
    )

    orders: dict[tuple[DocField, ...], list[int]] = {}
    for t, fields in DOCUMENT_BODIES.items():
        orders.setdefault(tuple(fields), []).append(t)
    first_null = {
        tuple(types): "case " + " ".join(f"when `{f.name}` is null then 'body field {f.key}'" for f in fields) + " end"
        for fields, types in orders.items()
    }
    error = f"""case
        when timestamp is null then 'timestamp is not in seconds'
        when epoch = 0 then 'zero epoch'
        when tickNumber = 0 then 'zero tickNumber'
        when timestamp = 0 then 'zero timestamp'
        when logDigest = '' then 'zero logDigest'
        when not __hash_ok then 'unexpected transaction hash'
        when logType not {_among(list(DOCUMENT_BODIES))} then 'unsupported type'
        when __misfit is not null then concat('body field ', __misfit)
        else {_per_type(first_null)} end"""
    return flat.selectExpr(*carried, *[f"`{c}`" for c in DOCUMENT_COLUMNS], f"{fence(error)} doc_error")


def identity_verdicts(rows: DataFrame, column: str = "tx_hash") -> DataFrame:
    """Distinct hashes, how many rows carry each, and whether it is a valid digest."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("logs"))
    return counts.withColumn("valid", is_identity(F.col(column)))


def doc_id(epoch: Column, log_id: Column) -> Column:
    """``<epoch>-<log id>``; the separator keeps 1-23 and 12-3 apart."""
    return F.concat_ws("-", epoch.cast("string"), log_id.cast("string"))


def document_json(documents: DataFrame) -> Column:
    """Document JSON in column order. Absent and empty values are left out, zeros are kept."""
    types = dict(documents.dtypes)

    def value(name: str) -> Column:
        column = F.col(name)
        if name == "logDigest":
            return column
        if types[name] == "string":
            return F.nullif(column, F.lit(""))
        if types[name] == "binary":
            return F.when(F.octet_length(column) > 0, column)
        return column

    return F.to_json(F.struct(*[value(c).alias(c) for c in DOCUMENT_COLUMNS]))


def bulk_ndjson(documents: DataFrame, index: str) -> DataFrame:
    """One ``value`` per document: the action line and the document line."""
    action = F.to_json(
        F.struct(
            F.struct(
                doc_id(F.col("epoch"), F.col("logId")).alias("_id"), F.lit(index).alias("_index")
            ).alias("index")
        )
    )
    return documents.select(F.concat_ws("\n", action, document_json(documents)).alias("value"))


def route_records(records: DataFrame, types: Sequence[int] = DEFAULT_SUPPORTED_TYPES, value: str = "value") -> DataFrame:
    """Topic records -> documents with ``status`` (processed, skipped, failed) and ``reason``.

    The order of checks decides the outcome: malformed, missing and zero
    fields fail a record of any type; then unsupported types are skipped;
    then the conversion may fail; then zero amounts are skipped.
    """
    early = """case when decode_error is not null then concat('decode ', decode_error)
        when missing is not null then concat('missing ', missing) when zero is not null then concat('zero ', zero) end"""
    decoded = validate_nonzero(validate_required(decode_event(records, value)))
    events = apply_defaults(decoded.withColumn("early", F.expr(early)))
    carried = [c for c in records.columns if c != value and c not in DOCUMENT_COLUMNS]
    keep = [*carried, "early", "index", "lastLogForTick"]
    unsupported = f"not logType {_among(types)}" if types else "true"
    docs = to_document(events, keep=keep, judged=f"early is null and not ({unsupported})")
    zero = "logType in (0, 8) and amount = 0"
    status = f"""case when early is not null then 'failed' when {unsupported} then 'skipped'
        when doc_error is not null then 'failed' when {zero} then 'skipped' else 'processed' end"""
    reason = f"""case when early is not null then early when {unsupported} then 'unsupported type'
        when doc_error is not null then doc_error when {zero} then 'zero amount' end"""
    return docs.selectExpr(
        *[f"`{c}`" for c in [*carried, "index", "lastLogForTick", *DOCUMENT_COLUMNS]],
        f"{fence(status)} status",
        f"{fence(reason)} reason",
    )
