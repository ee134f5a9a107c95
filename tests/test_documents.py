import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow.functions.identity import digest_of
from tickflow.operators.documents import (
    bulk_ndjson,
    doc_id,
    document_json,
    identity_verdicts,
    nonzero_amount,
    route_records,
    supported,
)
from tickflow.operators.validate import BadRecords, error_policy, parse_supported

DIGEST, OTHER = digest_of(np.array([[11, 22, 33, 44], [5, 6, 7, 2**64 - 1]], dtype=np.uint64))


def event(kind, body, **more):
    base = {
        "epoch": 200,
        "tickNumber": 43000000,
        "index": 3,
        "type": kind,
        "logId": 17,
        "logDigest": "ab12",
        "transactionHash": DIGEST,
        "timestamp": 1770000000,
        "bodySize": 8,
        "body": body,
    }
    base.update(more)
    return {k: v for k, v in base.items() if v is not ...}


def document(kind, **more):
    base = {
        "epoch": 200,
        "tickNumber": 43000000,
        "timestamp": 1770000000000,
        "transactionHash": DIGEST,
        "logId": 17,
        "logDigest": "ab12",
        "logType": kind,
    }
    base.update(more)
    return {k: v for k, v in base.items() if v is not ...}


def route(spark, events, **options):
    texts = [(i, e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(events)]
    routed = route_records(spark.createDataFrame(texts, "n int, value string"), **options)
    rows = routed.select("n", "status", "reason", document_json(routed).alias("doc")).orderBy("n").collect()
    return [(r["status"], r["reason"], json.loads(r["doc"]) if r["status"] == "processed" else None) for r in rows]


TRANSFER = {"source": "S", "destination": "D", "amount": 42}
ASSET = {"assetIssuer": "I", "assetName": "N", "source": "S", "destination": "D", "numberOfShares": 2}
MANAGED = {
    "assetIssuer": "I", "assetName": "N", "owner": "O", "numberOfShares": 3,
    "sourceContractIndex": 1, "destinationContractIndex": 2,
}
MESSAGE = {"scIndex": 1, "scLogType": 0, "content": "00FFab"}

PAIRS = [
    (event(0, TRANSFER), document(0, **TRANSFER)),
    (
        event(0, TRANSFER, transactionHash="SC_END_TICK_TX_43000000", dividend=True),
        document(0, **TRANSFER, transactionHash=..., categories=[4, 7]),
    ),
    (event(0, TRANSFER, dividend=True), document(0, **TRANSFER, categories=[7])),
    (event(0, TRANSFER, transactionHash=""), document(0, **TRANSFER, transactionHash=...)),
    (event(0, TRANSFER, transactionHash=...), document(0, **TRANSFER, transactionHash=...)),
    (event(0, {**TRANSFER, "amount": 42.0}), document(0, **TRANSFER)),
    (event(0, {**TRANSFER, "amount": 4.2e1, "extra": {"source": 1}}), document(0, **TRANSFER)),
    (event(0, {**TRANSFER, "source": ""}), document(0, destination="D", amount=42)),
    (
        event(
            1,
            {
                "assetIssuer": "I", "assetName": "N", "managingContractIndex": 0, "numberOfDecimalPlaces": 0,
                "numberOfShares": 345678901, "unitOfMeasurement": "0000000",
            },
        ),
        document(
            1, assetIssuer="I", assetName="N", managingContractIndex=0, numberOfDecimalPlaces=0,
            numberOfShares=345678901, unitOfMeasurement="AAAAAAAAAA==",
        ),
    ),
    (event(2, ASSET), document(2, **ASSET)),
    (event(3, ASSET), document(3, **ASSET)),
    *[(event(t, MESSAGE), document(t, contractIndex=1, contractMessageType=0, rawPayload="AP+r")) for t in (4, 5, 6)],
    (event(6, {**MESSAGE, "content": ""}), document(6, contractIndex=1, contractMessageType=0)),
    (
        event(8, {"source": "S", "amount": 750, "contractIndexBurnedFor": 13}, transactionHash="SC_BEGIN_TICK_TX_1"),
        document(8, source="S", amount=750, contractIndex=13, transactionHash=..., categories=[3]),
    ),
    (event(9, {"hex": "ff"}), document(9, rawPayload="/w==")),
    (event(10, {"hex": "00"}), document(10, rawPayload="AA==")),
    (event(11, MANAGED), document(11, **MANAGED)),
    (event(12, {**MANAGED, "possessor": "P"}), document(12, **MANAGED, possessor="P")),
    (
        event(13, {"contractIndex": 9, "deductedAmount": 1, "remainingAmount": -577}),
        document(13, contractIndex=9, deductedAmount=1, remainingAmount=-577),
    ),
    (
        event(14, {"queryingEntity": "Q", "queryId": 12, "interfaceIndex": 3, "type": 2, "status": "unresolvable"}),
        document(14, queryingEntity="Q", queryId=12, interfaceIndex=3, queryType=2, queryStatus=5),
    ),
    (
        event(
            15,
            {
                "subscriptionId": 4294967295, "interfaceIndex": 5, "contractIndex": 3, "periodInMilliseconds": 60000,
                "firstQueryDateAndTime": "2031-11-23 07:08:09.321'987",
            },
        ),
        document(
            15, subscriptionId=4294967295, interfaceIndex=5, contractIndex=3, periodMillis=60000,
            firstQueryTimestamp=1953184089321,
        ),
    ),
    (event(255, {"customMessage": "6217575821008262227"}), document(255, customMessage=6217575821008262227)),
    (event(255, {"customMessage": "18446744073709551615"}), document(255, customMessage=2**64 - 1)),
    (event(0, TRANSFER, logId=2**64 - 1), document(0, **TRANSFER, logId=2**64 - 1)),
    (event(0, TRANSFER, logId=0), document(0, **TRANSFER, logId=0)),
]


def test_topic_to_document(spark):
    got = route(spark, [e for e, _ in PAIRS])
    for (status, reason, doc), (_, expected) in zip(got, PAIRS, strict=True):
        assert (status, reason) == ("processed", None)
        assert doc == expected
    # The same with blanks after the colons, which takes the careful way.
    again = route(spark, [json.dumps(e, indent=2) + "\n" for e, _ in PAIRS])
    assert again == got


def test_document_key_order(spark):
    routed = route_records(spark.createDataFrame([(json.dumps(PAIRS[1][0]),)], "value string"))
    text = routed.select(document_json(routed)).first()[0]
    assert list(json.loads(text)) == [
        "epoch", "tickNumber", "timestamp", "logId", "logDigest", "logType", "categories", "source", "destination", "amount",
    ]


FAILURES = [
    ("{broken", "decode json"),
    ("", "decode json"),
    ("[1]", "decode json"),
    ('"text"', "decode json"),
    (json.dumps(event(0, TRANSFER)) + " x", "decode json"),
    (event(0, TRANSFER, epoch="200"), "decode epoch"),
    (event(0, TRANSFER, epoch=4294967296), "decode epoch"),
    (event(0, TRANSFER, epoch=-1), "decode epoch"),
    (event(0, TRANSFER, type=32768), "decode type"),
    (event(0, TRANSFER, logId=2**64), "decode logId"),
    (event(0, TRANSFER, logId=-1), "decode logId"),
    (event(0, TRANSFER, logId=1.5), "decode logId"),
    (event(0, TRANSFER, logDigest=5), "decode logDigest"),
    (event(0, TRANSFER, transactionHash={"a": 1}), "decode transactionHash"),
    (event(0, TRANSFER, dividend="true"), "decode dividend"),
    (event(0, [1]), "decode body"),
    (event(0, "{}"), "decode body"),
    (event(0, TRANSFER, epoch=...), "missing epoch"),
    (event(0, TRANSFER, type=..., index=..., logDigest=None, timestamp=..., logId=..., tickNumber=..., epoch=...),
     "missing epoch,tickNumber,logId,timestamp,logDigest,index,type"),
    (event(0, TRANSFER, epoch=0, tickNumber=0, logDigest="", timestamp=0), "zero epoch,tickNumber,logDigest,timestamp"),
    (event(0, TRANSFER, timestamp=10_000_000_001), "timestamp is not in seconds"),
    (event(0, TRANSFER, timestamp=2**64 - 1), "timestamp is not in seconds"),
    (event(0, TRANSFER, transactionHash="SC_UNKNOWN_TX_1"), "unexpected transaction hash"),
    (event(0, TRANSFER, transactionHash=DIGEST[:-1] + chr((ord(DIGEST[-1]) - 96) % 26 + 97)), "unexpected transaction hash"),
    (event(0, None), "body field source"),
    (event(0, ...), "body field source"),
    (event(0, {"destination": "D", "amount": 1}), "body field source"),
    (event(0, {**TRANSFER, "source": 5}), "body field source"),
    (event(0, {**TRANSFER, "destination": ["D"]}), "body field destination"),
    (event(0, {**TRANSFER, "amount": "1"}), "body field amount"),
    (event(0, {**TRANSFER, "amount": "NaN"}), "body field amount"),
    (event(0, {**TRANSFER, "amount": -1}), "body field amount"),
    (event(0, {**TRANSFER, "amount": 0.5}), "body field amount"),
    (event(4, {**MESSAGE, "content": "abc"}), "body field content"),
    (event(4, {**MESSAGE, "content": "zz"}), "body field content"),
    (event(12, MANAGED), "body field possessor"),
    (event(14, {"queryingEntity": "Q", "queryId": 1, "interfaceIndex": 3, "type": 32768, "status": "pending"}), "body field type"),
    (event(14, {"queryingEntity": "Q", "queryId": 1, "interfaceIndex": 3, "type": 1, "status": "PENDING"}), "body field status"),
    (event(255, {"customMessage": "-1"}), "body field customMessage"),
    (event(255, {"customMessage": 5}), "body field customMessage"),
]


def test_failures(spark):
    got = route(spark, [e for e, _ in FAILURES])
    assert [(status, reason) for status, reason, _ in got] == [("failed", reason) for _, reason in FAILURES]


def test_skips_and_their_order(spark):
    cases = [
        (event(0, {**TRANSFER, "amount": 0}), ("skipped", "zero amount")),
        (event(8, {"source": "S", "amount": 0, "contractIndexBurnedFor": 1}), ("skipped", "zero amount")),
        (event(6, {"foo": "bar"}), ("skipped", "unsupported type")),  # its body is never looked at
        (event(255, {"customMessage": "1"}), ("skipped", "unsupported type")),
        (event(6, {"foo": "bar"}, epoch=0), ("failed", "zero epoch")),  # but its envelope is
        (event(-1, TRANSFER), ("skipped", "unsupported type")),
    ]
    got = route(spark, [e for e, _ in cases], types=[0, 1, 2, 3, 8, 13])
    assert [(status, reason) for status, reason, _ in got] == [expected for _, expected in cases]
    assert route(spark, [event(0, TRANSFER)], types=[])[0][0] == "skipped"
    assert route(spark, [event(7, MESSAGE)])[0][:2] == ("skipped", "unsupported type")
    assert route(spark, [event(77, {"hex": ""})], types=[77])[0][:2] == ("failed", "unsupported type")


def test_limits_of_the_seconds_guard(spark):
    status, _, doc = route(spark, [event(0, TRANSFER, timestamp=10_000_000_000)])[0]
    assert status == "processed" and doc["timestamp"] == 10_000_000_000_000


def test_repeated_key_last_one_wins(spark):
    text = json.dumps(event(0, TRANSFER)).replace('"amount": 42', '"amount": 1, "amount": 42')
    assert route(spark, [text])[0][2]["amount"] == 42


def test_ids_and_bulk_lines(spark):
    ids = spark.createDataFrame([(1, 23), (12, 3)], "e bigint, l bigint").select(doc_id(F.col("e"), F.col("l")))
    assert [r[0] for r in ids.collect()] == ["1-23", "12-3"]
    routed = route_records(spark.createDataFrame([(json.dumps(PAIRS[0][0]),)], "value string"))
    action, line = bulk_ndjson(routed, "idx").first()["value"].split("\n")
    assert json.loads(action) == {"index": {"_index": "idx", "_id": "200-17"}}
    assert json.loads(line) == PAIRS[0][1]


def test_frame_filters(spark):
    types = spark.createDataFrame([(t,) for t in (0, 7, 255, 77)], "type bigint")
    assert [r[0] for r in supported(types).collect()] == [0, 255]
    rows = spark.createDataFrame([(0, 0), (8, 0), (0, 1), (2, None), (13, 0)], "logType bigint, amount bigint")
    assert [tuple(r) for r in nonzero_amount(rows).collect()] == [(0, 1), (2, None), (13, 0)]


def test_identity_verdicts(spark):
    rows = spark.createDataFrame([(DIGEST,), (DIGEST,), (OTHER,), ("SC_X",)], "tx_hash string")
    got = {r["tx_hash"]: (r["logs"], r["valid"]) for r in identity_verdicts(rows).collect()}
    assert got == {DIGEST: (2, True), OTHER: (1, True), "SC_X": (1, False)}


def test_error_policy(spark):
    routed = spark.createDataFrame([("processed", None), ("failed", "why")], "status string, reason string")
    error_policy(routed, "quarantine")
    with pytest.raises(BadRecords, match="why"):
        error_policy(routed, "strict")
    error_policy(routed.filter("status = 'processed'"), "strict")
    with pytest.raises(ValueError):
        error_policy(routed, "other")


def test_supported_config():
    assert parse_supported('{"0":[0,1,255]}') == [0, 1, 255]
    assert parse_supported('{"1":[0]}') == []
    assert parse_supported("null") == []
    for bad in ("[]", '{"0":["x"]}', '{"0":[99999]}', "{"):
        with pytest.raises(ValueError):
            parse_supported(bad)


def test_filter_on_a_verdict_does_not_copy_the_parser(spark):
    routed = route_records(spark.createDataFrame([("{}",)], "value string")).filter("status = 'processed'")
    plan = routed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") <= 4
