import json

import pytest

from pyspark.sql import functions as F

from tickflow.operators.bodies import parse_body, rename_body, rename_stored_body, source_body_json
from tickflow.schemas import SOURCE_BODIES


def _parse(spark, rows):
    frame = spark.createDataFrame([(t, b) for t, b in rows], "type bigint, body string")
    out = parse_body(frame).selectExpr(f"{source_body_json()} as source", f"{rename_body()} as topic", "parse_error")
    return [
        (r["source"] and json.loads(r["source"]), r["topic"] and json.loads(r["topic"]), r["parse_error"])
        for r in out.collect()
    ]


def test_every_type_round_trips_and_is_renamed(spark):
    samples = {"str": "x", "i64": -5, "i32": -7, "u32": 4294967295, "u64": 18446744073709551615}
    rows, expected = [], []
    for code, fields in SOURCE_BODIES.items():
        body = {f.key: samples[f.kind] for f in fields}
        rows.append((code, json.dumps(body)))
        expected.append((body, {f.topic_key: samples[f.kind] for f in fields}, None))
    assert _parse(spark, rows) == expected


def test_keys_are_sorted(spark):
    frame = spark.createDataFrame([(0, '{"to":"b","from":"a","amount":1}')], "type bigint, body string")
    row = parse_body(frame).selectExpr(f"{source_body_json()} s", f"{rename_body()} t").first()
    assert row["s"] == '{"amount":1,"from":"a","to":"b"}'
    assert row["t"] == '{"amount":1,"destination":"b","source":"a"}'


def test_absent_null_and_extra_keys(spark):
    rows = [
        (0, None),
        (0, "null"),
        (0, "{}"),
        (0, '{"from":"a","amount":null,"scIndex":"not a number","status":5}'),
        (77, '{"hex":"00ff","other":1}'),
        (9, "{}"),
    ]
    zero = {"from": "", "to": "", "amount": 0}
    renamed = {"source": "", "destination": "", "amount": 0}
    assert _parse(spark, rows) == [
        (None, None, None),
        (zero, renamed, None),
        (zero, renamed, None),
        ({**zero, "from": "a"}, {**renamed, "source": "a"}, None),
        ({"hex": "00ff"}, {"hex": "00ff"}, None),
        ({"hex": ""}, {"hex": ""}, None),
    ]


def test_errors(spark):
    rows = [
        (0, '{"from":5,"to":"b","amount":1}'),
        (0, '{"from":"a","to":"b","amount":"1"}'),
        (0, '{"from":"a","to":"b","amount":1.5}'),
        (0, '{"from":"a","to":"b","amount":1.0}'),
        (0, '{"from":"a","to":"b","amount":9223372036854775808}'),
        (0, '{"from":"a","to":{"x":1},"amount":1}'),
        (0, '{"from" : 5, "to" : "b", "amount" : 1}'),
        (8, '{"publicKey":"a","amount":1,"contractIndexBurnedFor":4294967296}'),
        (8, '{"publicKey":"a","amount":1,"contractIndexBurnedFor":-1}'),
        (13, '{"deductedAmount":18446744073709551616,"remainingAmount":1,"contractIndex":1}'),
        (13, '{"deductedAmount":-1,"remainingAmount":1,"contractIndex":1}'),
        (15, '{"subscriptionId":2147483648,"interfaceIndex":1,"contractIndex":1,"periodInMilliseconds":1,"firstQueryDateAndTime":""}'),
        (0, "[1]"),
        (0, '"text"'),
        (0, "{broken"),
        (77, '{"hex":1}'),
    ]
    errors = [error for _, _, error in _parse(spark, rows)]
    assert errors == [
        "from", "amount", "amount", "amount", "amount", "to", "from", "contractIndexBurnedFor", "contractIndexBurnedFor",
        "deductedAmount", "deductedAmount", "subscriptionId", "body", "body", "body", "hex",
    ]


def test_blanks_in_json_are_fine(spark):
    assert _parse(spark, [(0, '{ "from" : "a" , "to" : "b" , "amount" : 1 }')])[0][2] is None


def test_variant_bodies_parse_like_text(spark):
    rows = [(0, '{"from":"a","to":"b","amount":1}'), (0, "null"), (0, '"text"'), (0, None), (0, '{"from":1}')]
    text = spark.createDataFrame(rows, "type bigint, body string")
    columns = [F.to_json("parsed").alias("p"), "parse_error"]
    as_text = [tuple(r) for r in parse_body(text).select(*columns).collect()]
    variant = text.withColumn("body", F.try_parse_json("body"))
    assert [tuple(r) for r in parse_body(variant).select(*columns).collect()] == as_text


def test_stored_bodies(spark):
    rows = [
        (0, '{"from":"a","to":"b","amount":1}', '{"amount":1,"destination":"b","source":"a"}', None),
        (0, '{"from":"a"}', '{"amount":null,"destination":null,"source":"a"}', None),
        (3, '{"sourcePublicKey":"s"}', '{"assetIssuer":null,"assetName":null,"destination":null,"numberOfShares":null,"source":"s"}', None),
        (13, '{"deductedAmount":1,"anything":2}', '{"deductedAmount":1,"anything":2}', None),
        (255, '{"customMessage":"1"}', '{"customMessage":"1"}', None),
        (0, None, None, None),
        (77, None, None, None),
        (77, '{"hex":"00"}', None, "unsupported type"),
    ]
    frame = spark.createDataFrame([(t, b) for t, b, _, _ in rows], "event_type bigint, body string")
    got = rename_stored_body(frame).select("topic_body", "rename_error").collect()
    assert [tuple(r) for r in got] == [(topic, error) for _, _, topic, error in rows]


DEEP = '{"d":' * 6 + '{"from":2}' + "}" * 6


@pytest.mark.parametrize(
    ("body", "error"),
    [
        ('{"from":5,"to":"b","amount":1,"memo":{"from":"z"}}', "from"),
        ('{"from":"a","from":5,"to":"b","amount":1}', "from"),
        ('{"from" :5,"to":"b","amount":1,"memo":{"from":"z"}}', "from"),
        ('{"fr\\u006fm":5,"to":"b","amount":1,"memo":{"from":"z"}}', "from"),
        ('{"from":"a","to":"b","amount":1,"x":%s}' % DEEP, None),
        ('{"from":"a","to":"b","amount":1,"x":[[[[[["from"]]]]]]}', None),
        ('{ "from" : "a" , "to" : "b" , "amount" : 1 }', None),
        ('{"from":"a","to":"b","amount":"1","y":", from: BIGINT"}', "amount"),
        ('{"from":"a","to":"b","amount":1,"q, from: BIGINT":1}', None),
        ("[1]", "body"),
        ("{}", None),
    ],
)
def test_types_are_those_of_the_top_level(spark, body, error):
    frame = spark.createDataFrame([(0, body)], "type long, body string")
    row = parse_body(frame).first()
    assert row["parse_error"] == error
