from datetime import UTC, datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow.functions import (
    dividend_marker,
    hex_to_binary,
    is_identity,
    oracle_state,
    parse_uint64_text,
    parse_utc_millis,
    to_byte,
    to_int64,
    to_positive_int16,
    to_uint32,
    to_uint64,
    tx_category,
    type_name,
    unit_of_measurement,
)
from tickflow.functions.identity import valid_digests

#: Digests with a right checksum.
DIGESTS = [
    "joieezsjflprlgerjphlyuwsykzabipxkyjqgwfnbgeyuuhfoocugmbembwd",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaafxib",
]


@pytest.mark.parametrize(
    ("convert", "number", "expected"),
    [
        (to_uint64, "77D", 77),
        (to_uint64, "-0.0D", 0),
        (to_uint64, "-64D", None),
        (to_uint64, "8.125D", None),
        (to_uint64, "4503599627370497D", 2**52 + 1),
        (to_uint64, "9223372036854775808D", 2**63),
        (to_uint64, "18446744073709549568D", 2**64 - 2**11),
        (to_uint64, "18446744073709551616D", None),
        (to_uint64, "cast('NaN' as double)", None),
        (to_uint64, "cast('-Infinity' as double)", None),
        (to_int64, "-40D", -40),
        (to_int64, "0.25D", None),
        (to_int64, "-9223372036854775808D", -(2**63)),
        (to_int64, "9223372036854775808D", None),
        (to_uint32, "4294967295D", 2**32 - 1),
        (to_uint32, "4294967296D", None),
        (to_uint32, "-3D", None),
        (to_uint32, "1.75D", None),
        (to_positive_int16, "32767D", 2**15 - 1),
        (to_positive_int16, "32768D", None),
        (to_positive_int16, "6.5D", None),
        (to_positive_int16, "-2D", None),
        (to_byte, "255D", 255),
        (to_byte, "256D", None),
        (to_byte, "-5D", None),
        (to_byte, "9.75D", 9),
        (to_byte, "cast('NaN' as double)", None),
    ],
)
def test_numbers(value, convert, number, expected):
    got = value(convert("x"), x=number)
    assert (int(got) if isinstance(got, Decimal) else got) == expected


def _millis(*fields):
    return round(datetime(*fields, tzinfo=UTC).timestamp() * 1000)


@pytest.mark.parametrize("moment", [(1999, 2, 28, 7, 8, 9), (2000, 2, 29, 23, 0, 1), (2100, 3, 1, 0, 59, 59), (2031, 12, 31, 12, 12, 12)])
@pytest.mark.parametrize("part", [0, 7, 640])
def test_date_time(value, moment, part):
    text = "{:04}-{:02}-{:02} {:02}:{:02}:{:02}".format(*moment) + f".{part:03}\\'042"
    assert int(value(parse_utc_millis("s"), s=f"'{text}'")) == _millis(*moment) + part
    assert int(value(parse_utc_millis("s"), s=f"'{text} trailing'")) == _millis(*moment) + part


def test_date_time_fields_carry_over(value):
    def got(text):
        out = value(parse_utc_millis("s"), s=f"'{text}'")
        return None if out is None else int(out)

    assert got("2018-15-03 00:00:00.000\\'000") == _millis(2019, 3, 3)
    assert got("2018-02-30 00:00:00.000\\'000") == _millis(2018, 3, 2)
    assert got("2018-06-01 30:90:75.000\\'000") == _millis(2018, 6, 2, 7, 31, 15)
    assert got("1969-12-31 23:59:58.000\\'000") == 2**64 - 2000
    for bad in ("soon", "2018-06-01 10:11:12", "2018-06-01 10:11:12.5.6", "06:07:08.009\\'010", "2018/06/01 10:11:12.000\\'000"):
        assert got(bad) is None, bad


@pytest.mark.parametrize(
    ("year", "month", "day"),
    [(12025, 2, 29), (123456789, 12, 31), (0, 3, 1), (-1, 1, 1), (-400, 2, 29), (2_147_483_648, 7, 4), (1900, 2, 28), (10000, 14, 35), (292277026596, 12, 4), (2**63 - 1, 1, 1)],
)
def test_any_year(value, year, month, day):
    """Four hundred years are a whole number of days: the same day in a year that the standard library knows, and the eras between."""
    near = 2000 + year % 400
    eras = (year - near) // 400
    expected = (_millis(near + (month - 1) // 12, (month - 1) % 12 + 1, 1) + (day - 1) * 86_400_000 + eras * 146_097 * 86_400_000 + 3_723_004) % 2**64
    assert int(value(parse_utc_millis("s"), s=f"'{year}-{month}-{day} 01:02:03.004\\'005'")) == expected


def test_years_beyond_64_bits_are_not_valid(value):
    assert value(parse_utc_millis("s"), s=f"'{2**63}-01-01 00:00:00.000\\'000'") is None


def test_text_conversions(value):
    def hexed(s):
        return value(hex_to_binary("s"), s=f"'{s}'")

    assert hexed("0aFF") == b"\x0a\xff"
    assert hexed("") == b""
    assert hexed("abc") is None
    assert hexed("zz") is None
    unit = unit_of_measurement("s")
    assert value(unit, s="'0000000'") == bytes(7)
    assert value(unit, s="'1234567'") == bytes(range(1, 8))
    assert value(unit, s="'/ 0z~0!'") == bytes((ord(c) - 48) % 256 for c in "/ 0z~0!")
    assert value(unit, s="'äöü1'") == bytes((b - 48) % 256 for b in "äöü1".encode())  # 7 bytes
    assert value(unit, s="'123456'") is None
    states = [value(oracle_state("s"), s=f"'{s}'") for s in ("pending", "committed", "success", "timeout", "unresolvable", "PENDING", "")]
    assert states == [1, 2, 3, 4, 5, None, None]
    number = parse_uint64_text("s")
    assert value(number, s="'18446744073709551615'") == 2**64 - 1
    assert value(number, s="'0000000000000000000000000000007'") == 7
    assert value(number, s="'0'") == 0
    for bad in ("18446744073709551616", "99999999999999999999999999", "-1", "+1", "1.0", "", " 1", "1e3"):
        assert value(number, s=f"'{bad}'") is None, bad


@pytest.mark.parametrize(
    ("tx_hash", "expected"),
    [
        ("SC_INITIALIZE_TX_67890", 1),
        ("SC_BEGIN_EPOCH_TX_1", 2),
        ("SC_BEGIN_TICK_TX_1", 3),
        ("SC_END_TICK_TX_12345", 4),
        ("SC_END_TICK_TX_anything", 4),
        ("SC_END_EPOCH_TX_33333", 5),
        ("SC_NOTIFICATION_TX_44444", 6),
        ("SC_NOTIFICATION_TX44444", 6),
        ("SC_INVALID_TX_12345", None),
        ("SC_ENDTICK", None),
        ("SC_", None),
        ("", None),
        ("END_TICK_TX_1", None),
    ],
)
def test_tx_category(value, tx_hash, expected):
    assert value(tx_category("h"), h=f"'{tx_hash}'") == expected


def test_names_and_markers(value):
    assert value(type_name("t"), t="13") == "contract_reserve_deduction"
    assert value(type_name("t"), t="77") == "unknown"
    marker = dividend_marker("t", "m")
    assert value(marker, t="255", m="'6217575821008262227'") == 1
    assert value(marker, t="255", m="'6217575821008457285'") == 0
    assert value(marker, t="255", m="'1'") is None
    assert value(marker, t="0", m="'6217575821008262227'") is None


def test_digests():
    good = np.array(DIGESTS, dtype=object)
    assert valid_digests(good).all()
    # One changed letter, anywhere, breaks the checksum (or the number does not fit in 64 bits).
    for i in range(60):
        text = DIGESTS[0]
        changed = text[:i] + ("a" if text[i] != "a" else "b") + text[i + 1 :]
        assert not valid_digests(np.array([changed], dtype=object))[0]
    assert len(valid_digests(np.array([], dtype=object))) == 0


def test_is_identity_column(spark):
    texts = [*DIGESTS, DIGESTS[0].upper(), DIGESTS[0][:-1], DIGESTS[0] + "\n", "SC_END_TICK_TX_1", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["ok"] for r in frame.select(is_identity(F.col("t")).alias("ok")).collect()]
    assert got == [True] * len(DIGESTS) + [False] * 6
