"""Conversions of text fields. NULL means: not valid."""

from __future__ import annotations

from tickflow.schemas import ORACLE_STATES, UINT64_MAX

# Date, time, milliseconds and microseconds; text after the last field is ignored.
_STAMP = (
    r"\A\s*([+-]?\d+)-([+-]\d|\d{1,2})-([+-]\d|\d{1,2})[ \t]+"
    r"([+-]\d|\d{1,2}):([+-]\d|\d{1,2}):([+-]\d|\d{1,2})\.([+-]\d{1,2}|\d{1,3})'([+-]\d{1,2}|\d{1,3})"
)


def hex_to_binary(s: str) -> str:
    """Hex digits of either case, an even number of them; the empty text is an empty value."""
    return f"case when length({s}) % 2 = 0 then try_to_binary({s}, 'hex') end"


def unit_of_measurement(s: str) -> str:
    """Exactly 7 bytes, each shifted down by 48 (modulo 256).

    The bytes are one 56-bit number; the high bit of every byte is set during
    the subtraction, so that no byte borrows from the next one.
    """
    high, shift = int("80" * 7, 16), int("30" * 7, 16)
    x = f"cast(conv(hex({s}), 16, 10) as bigint)"
    shifted = f"((({x} | {high}) - {shift}) ^ (~{x} & {high}))"
    return f"case when octet_length({s}) = 7 then unhex(lpad(hex({shifted}), 14, '0')) end"


def oracle_state(s: str) -> str:
    branches = " ".join(f"when '{name}' then {code}" for name, code in ORACLE_STATES.items())
    return f"cast(case {s} {branches} end as smallint)"


def parse_uint64_text(s: str) -> str:
    """Base-10 digits only, below 2^64 (leading zeros do not count)."""
    number = f"try_cast({s} as decimal(38,0))"
    return (
        rf"case when {s} rlike r'\A0*[0-9]{{1,20}}\z' and {number} <= {UINT64_MAX}"
        f" then cast({number} as decimal(20,0)) end"
    )


def civil_days(year: str, month: str, day: str) -> str:
    """Days from 1970-01-01 in the Gregorian calendar of all times, by integer arithmetic: any year, months and days
    beyond their usual range carry over. ``year`` is a DECIMAL(20,0), the others are INTs.

    A year is counted from March here, so that the leap day is its last; 400 years have 146,097 days.
    """
    m = f"pmod({month} - 3, 12)"
    y = f"({year} + cast(floor(({month} - 3) / 12D) as int))"
    in_era = f"cast(pmod({y}, 400) as bigint)"
    eras = f"cast((({y} - pmod({y}, 400)) div 400) as decimal(20,0))"
    in_year = f"((153 * {m} + 2) div 5 + {day} - 1)"
    return f"({eras} * 146097 + ({in_era} * 365 + {in_era} div 4 - {in_era} div 100 + {in_year} - 719468))"


def parse_utc_millis(s: str) -> str:
    """``Y-MM-DD HH:MM:SS.mmm'uuu`` in UTC -> Unix milliseconds.

    The year is any 64-bit integer. Fields beyond their usual range carry over (month 13 is January of the next year).
    Microseconds below a full millisecond are dropped. Moments before 1970, and those too late for 64 bits, wrap
    around as unsigned 64-bit values do.
    """
    n = [f"""try_cast(regexp_extract({s}, r"{_STAMP}", {i}) as int)""" for i in range(2, 9)]
    year = f"""cast(try_cast(regexp_extract({s}, r"{_STAMP}", 1) as bigint) as decimal(20,0))"""
    millis = (
        f"{civil_days(year, n[0], n[1])} * 86400000 + ({n[2]} * 3600000L + {n[3]} * 60000L + {n[4]} * 1000L"
        f" + floor(({n[5]} * 1000 + {n[6]}) / 1000D))"
    )
    return f"""case when {s} rlike r"{_STAMP}" then cast(pmod(cast({millis} as decimal(38,0)), {UINT64_MAX + 1}) as decimal(20,0)) end"""
