"""Type codes, field tables and schemas of the log-event model.

Everything in this file is data: the operators are built from these tables,
so a new log type is one more entry here.
"""

from __future__ import annotations

from typing import NamedTuple

# Log type codes and their names.
TYPE_NAMES = {
    0: "qu_transfer",
    1: "asset_issuance",
    2: "asset_ownership_change",
    3: "asset_possession_change",
    4: "contract_error_message",
    5: "contract_warning_message",
    6: "contract_information_message",
    7: "contract_debug_message",
    8: "burning",
    9: "dust_burning",
    10: "spectrum_stats",
    11: "asset_ownership_managing_contract_change",
    12: "asset_possession_managing_contract_change",
    13: "contract_reserve_deduction",
    14: "oracle_query_status_change",
    15: "oracle_subscriber_log_message",
    255: "custom_message",
}

#: Type of the records that stand in the topic for rejected logs. No log has it and no reader supports it, so that it is
#: counted as skipped and its tick still completes.
REJECTED_TYPE = 32767

# Categories of system transactions, by hash prefix.
SYSTEM_TX_CATEGORIES = {
    "SC_INITIALIZE_TX": 1,
    "SC_BEGIN_EPOCH_TX": 2,
    "SC_BEGIN_TICK_TX": 3,
    "SC_END_TICK_TX": 4,
    "SC_END_EPOCH_TX": 5,
    "SC_NOTIFICATION_TX": 6,
}
DIVIDEND_CATEGORY = 7

# Custom messages that open and close a dividend section.
DIVIDENDS_START = "6217575821008262227"
DIVIDENDS_END = "6217575821008457285"

# Oracle query states.
ORACLE_STATES = {"pending": 1, "committed": 2, "success": 3, "timeout": 4, "unresolvable": 5}

# Type 7 (debug message) is not indexed unless asked for.
DEFAULT_SUPPORTED_TYPES = tuple(t for t in TYPE_NAMES if t != 7)

CUSTOM_MESSAGE = 255
MAX_SECONDS = 10_000_000_000
UINT16_MAX = 2**16 - 1
UINT32_MAX = 2**32 - 1
INT64_MAX = 2**63 - 1
UINT64_MAX = 2**64 - 1


class BodyField(NamedTuple):
    """One field of a typed source body: its key, JSON kind and topic-side key."""

    key: str
    kind: str
    topic_key: str


def _same(*fields: tuple[str, str]) -> list[BodyField]:
    return [BodyField(key, kind, key) for key, kind in fields]


_ASSET_TRANSFER = [
    BodyField("sourcePublicKey", "str", "source"),
    BodyField("destinationPublicKey", "str", "destination"),
    BodyField("issuerPublicKey", "str", "assetIssuer"),
    BodyField("assetName", "str", "assetName"),
    BodyField("numberOfShares", "i64", "numberOfShares"),
]
_MANAGEMENT_CHANGE = [
    BodyField("ownershipPublicKey", "str", "owner"),
    BodyField("issuerPublicKey", "str", "assetIssuer"),
    BodyField("sourceContractIndex", "u32", "sourceContractIndex"),
    BodyField("destinationContractIndex", "u32", "destinationContractIndex"),
    BodyField("numberOfShares", "i64", "numberOfShares"),
    BodyField("assetName", "str", "assetName"),
]
_CONTRACT_MESSAGE = _same(("scIndex", "u32"), ("scLogType", "u32"), ("content", "str"))
_HEX = _same(("hex", "str"))

#: Fixed values (keys and types of the protocol): source body of every known type. Types that are not listed carry ``HEX_BODY``.
SOURCE_BODIES: dict[int, list[BodyField]] = {
    0: [
        BodyField("from", "str", "source"),
        BodyField("to", "str", "destination"),
        BodyField("amount", "i64", "amount"),
    ],
    1: [
        BodyField("issuerPublicKey", "str", "assetIssuer"),
        BodyField("numberOfShares", "i64", "numberOfShares"),
        BodyField("managingContractIndex", "i64", "managingContractIndex"),
        BodyField("name", "str", "assetName"),
        BodyField("numberOfDecimalPlaces", "i64", "numberOfDecimalPlaces"),
        BodyField("unitOfMeasurement", "str", "unitOfMeasurement"),
    ],
    2: _ASSET_TRANSFER,
    3: _ASSET_TRANSFER,
    4: _CONTRACT_MESSAGE,
    5: _CONTRACT_MESSAGE,
    6: _CONTRACT_MESSAGE,
    7: _CONTRACT_MESSAGE,
    8: [
        BodyField("publicKey", "str", "source"),
        BodyField("amount", "i64", "amount"),
        BodyField("contractIndexBurnedFor", "u32", "contractIndexBurnedFor"),
    ],
    9: _HEX,
    10: _HEX,
    11: _MANAGEMENT_CHANGE,
    12: [BodyField("possessionPublicKey", "str", "possessor"), *_MANAGEMENT_CHANGE],
    13: _same(("deductedAmount", "u64"), ("remainingAmount", "i64"), ("contractIndex", "u32")),
    14: _same(
        ("queryingEntity", "str"),
        ("queryId", "i64"),
        ("interfaceIndex", "u32"),
        ("type", "u32"),
        ("status", "str"),
    ),
    15: _same(
        ("subscriptionId", "i32"),
        ("interfaceIndex", "u32"),
        ("contractIndex", "u32"),
        ("periodInMilliseconds", "u32"),
        ("firstQueryDateAndTime", "str"),
    ),
    255: _same(("customMessage", "str")),
}
HEX_BODY = _HEX

#: Types whose stored body is renamed on replay; every other known type keeps its keys.
RENAMED_TYPES = tuple(
    t for t, fields in SOURCE_BODIES.items() if any(f.key != f.topic_key for f in fields)
)


class DocField(NamedTuple):
    """One document field: topic key it is read from, target name and conversion rule."""

    key: str
    name: str
    rule: str


_DOC_ASSET_TRANSFER = [
    DocField("assetIssuer", "assetIssuer", "text"),
    DocField("assetName", "assetName", "text"),
    DocField("source", "source", "text"),
    DocField("destination", "destination", "text"),
    DocField("numberOfShares", "numberOfShares", "u64"),
]
_DOC_MANAGEMENT_CHANGE = [
    DocField("assetIssuer", "assetIssuer", "text"),
    DocField("assetName", "assetName", "text"),
    DocField("numberOfShares", "numberOfShares", "u64"),
    DocField("sourceContractIndex", "sourceContractIndex", "u64"),
    DocField("destinationContractIndex", "destinationContractIndex", "u64"),
    DocField("owner", "owner", "text"),
]
_DOC_CONTRACT_MESSAGE = [
    DocField("scIndex", "contractIndex", "u64"),
    DocField("scLogType", "contractMessageType", "u64"),
    DocField("content", "rawPayload", "hex"),
]
_DOC_RAW = [DocField("hex", "rawPayload", "hex")]

#: Fixed values (names that readers expect): topic body -> document, per type, in the order in which fields are checked.
DOCUMENT_BODIES: dict[int, list[DocField]] = {
    0: [
        DocField("source", "source", "text"),
        DocField("destination", "destination", "text"),
        DocField("amount", "amount", "u64"),
    ],
    1: [
        DocField("assetIssuer", "assetIssuer", "text"),
        DocField("assetName", "assetName", "text"),
        DocField("managingContractIndex", "managingContractIndex", "u64"),
        DocField("numberOfDecimalPlaces", "numberOfDecimalPlaces", "byte"),
        DocField("numberOfShares", "numberOfShares", "u64"),
        DocField("unitOfMeasurement", "unitOfMeasurement", "unit"),
    ],
    2: _DOC_ASSET_TRANSFER,
    3: _DOC_ASSET_TRANSFER,
    4: _DOC_CONTRACT_MESSAGE,
    5: _DOC_CONTRACT_MESSAGE,
    6: _DOC_CONTRACT_MESSAGE,
    7: _DOC_CONTRACT_MESSAGE,
    8: [
        DocField("source", "source", "text"),
        DocField("amount", "amount", "u64"),
        DocField("contractIndexBurnedFor", "contractIndex", "u64"),
    ],
    9: _DOC_RAW,
    10: _DOC_RAW,
    11: _DOC_MANAGEMENT_CHANGE,
    12: [*_DOC_MANAGEMENT_CHANGE, DocField("possessor", "possessor", "text")],
    13: [
        DocField("contractIndex", "contractIndex", "u64"),
        DocField("deductedAmount", "deductedAmount", "u64"),
        DocField("remainingAmount", "remainingAmount", "i64"),
    ],
    14: [
        DocField("queryingEntity", "queryingEntity", "text"),
        DocField("queryId", "queryId", "u64"),
        DocField("interfaceIndex", "interfaceIndex", "u64"),
        DocField("type", "queryType", "i16"),
        DocField("status", "queryStatus", "state"),
    ],
    15: [
        DocField("subscriptionId", "subscriptionId", "u32"),
        DocField("interfaceIndex", "interfaceIndex", "u64"),
        DocField("contractIndex", "contractIndex", "u64"),
        DocField("periodInMilliseconds", "periodMillis", "u64"),
        DocField("firstQueryDateAndTime", "firstQueryTimestamp", "datetime"),
    ],
    255: [DocField("customMessage", "customMessage", "u64text")],
}

#: Optional document fields in output order.
DOCUMENT_OPTIONAL = [
    "contractIndex",
    "contractMessageType",
    "source",
    "destination",
    "amount",
    "assetName",
    "assetIssuer",
    "numberOfShares",
    "managingContractIndex",
    "unitOfMeasurement",
    "numberOfDecimalPlaces",
    "deductedAmount",
    "remainingAmount",
    "owner",
    "possessor",
    "sourceContractIndex",
    "destinationContractIndex",
    "customMessage",
    "rawPayload",
    "queryingEntity",
    "queryId",
    "queryType",
    "queryStatus",
    "subscriptionId",
    "interfaceIndex",
    "periodMillis",
    "firstQueryTimestamp",
]

#: All document columns in output order.
DOCUMENT_COLUMNS = [
    "epoch",
    "tickNumber",
    "timestamp",
    "transactionHash",
    "logId",
    "logDigest",
    "logType",
    "categories",
    *DOCUMENT_OPTIONAL,
]

#: Fields of a raw log inside a tick-stream message (fixed names): JSON kind, SQL type, and the value if absent. The flag and
#: the body have no such value; the body stays JSON text until it is typed.
LOG_FIELDS = {
    "ok": ("bool", "BOOLEAN", None),
    "epoch": ("int", "BIGINT", "0L"),
    "tick": ("int", "BIGINT", "0L"),
    "type": ("int", "BIGINT", "0L"),
    "logId": ("u64", "BIGINT", "cast(0 as decimal(20,0))"),
    "logDigest": ("str", "STRING", "''"),
    "bodySize": ("int", "BIGINT", "0L"),
    "logTypename": ("str", "STRING", None),
    "timestamp": ("int", "BIGINT", "0L"),
    "txHash": ("str", "STRING", "''"),
    "body": ("obj", "STRING", None),
}
#: Ranges of its numbers. Times beyond 63 bits are refused here already; as milliseconds they fit nowhere.
LOG_RANGES = {
    "epoch": (0, UINT16_MAX),
    "tick": (0, UINT32_MAX),
    "type": (0, UINT32_MAX),
    "logId": (0, UINT64_MAX),
    "bodySize": (0, UINT32_MAX),
    "timestamp": (0, INT64_MAX),
}

#: Keys of one tick-stream notification (JSON-RPC 2.0) or error response.
MESSAGE_SCHEMA = (
    "jsonrpc STRING, method STRING,"
    " params STRUCT<subscription: STRING, result: STRUCT<epoch: BIGINT, tick: BIGINT,"
    " isCatchUp: BOOLEAN, isSkipped: BOOLEAN, totalLogs: BIGINT, filteredLogs: BIGINT,"
    " catchUpComplete: BOOLEAN, logs: ARRAY<STRING>>>,"
    " error STRUCT<code: BIGINT, message: STRING>"
)

#: Stored events (parquet, partitioned by epoch).
STORED_SCHEMA = (
    "epoch BIGINT, tick BIGINT, log_id DECIMAL(20,0), event_type BIGINT, tx_hash STRING,"
    " timestamp BIGINT, body STRING, index_in_tick BIGINT, log_digest STRING,"
    " last_log_for_tick BOOLEAN"
)
STORED_COLUMNS = [c.strip().split(" ")[0] for c in STORED_SCHEMA.replace("(20,0)", "").split(",")]
