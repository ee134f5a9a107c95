"""Classification of transaction hashes and custom messages, and type names."""

from __future__ import annotations

from tickflow.schemas import CUSTOM_MESSAGE, DIVIDENDS_END, DIVIDENDS_START, SYSTEM_TX_CATEGORIES, TYPE_NAMES

_NOTIFICATION = "SC_NOTIFICATION_TX"


def type_name(code: str) -> str:
    """Name of a log type code; ``unknown`` for codes that have none."""
    branches = " ".join(f"when {t} then '{name}'" for t, name in TYPE_NAMES.items())
    return f"case {code} {branches} else 'unknown' end"


def tx_category(tx_hash: str) -> str:
    """Category 1-6 of a system transaction hash ``<prefix>_<anything>``, else NULL.

    Notifications are also known without the separator before their suffix.
    """
    prefix = f"left({tx_hash}, length({tx_hash}) - length(substring_index({tx_hash}, '_', -1)) - 1)"
    branches = " ".join(f"when '{name}' then {code}" for name, code in SYSTEM_TX_CATEGORIES.items())
    broken = f"case when startswith({tx_hash}, '{_NOTIFICATION}') then {SYSTEM_TX_CATEGORIES[_NOTIFICATION]} end"
    return f"case when startswith({tx_hash}, 'SC_') then coalesce(case {prefix} {branches} end, {broken}) end"


def dividend_marker(log_type: str, custom_message: str) -> str:
    """1 opens a dividend section, 0 closes it, NULL is no marker."""
    return (
        f"case when {log_type} = {CUSTOM_MESSAGE} then"
        f" case {custom_message} when '{DIVIDENDS_START}' then 1 when '{DIVIDENDS_END}' then 0 end end"
    )
