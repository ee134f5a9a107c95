"""JSON text to typed structs, with the JSON types of the values checked.

``from_json`` reads a whole struct in one pass, but it takes a number where a
text is wanted, and it does not tell an absent key from one of the wrong type.
A row is above suspicion if nothing was corrupt, no character is escaped, and every text key stands
in it once, followed by a quote, or not at all: plain substring tests. Only the others (wrong types,
repeated or nested keys, text with blanks around its colons) are parsed a second time to
look at the types of their top-level keys, at any depth of nesting.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

#: JSON types (as VARIANT reports them) that fit a kind; null fits all of them.
_FITS = {
    "str": "STRING",
    "int": "BIGINT",
    "u64": r"BIGINT|DECIMAL\((?:19|20),0\)",
    "num": r"BIGINT|DOUBLE|DECIMAL\(",
    "bool": "BOOLEAN",
    "obj": "OBJECT",
}
_OPTIONS = (
    "map('columnNameOfCorruptRecord', '__bad', 'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"
)


def from_json(text: str, fields: Mapping[str, str]) -> str:
    """``text`` as a struct of ``fields`` (name -> SQL type) and ``__bad``."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
    return f"from_json({text}, '{schema}, __bad STRING', {_OPTIONS})"


def suspect_kinds(text: str, parsed: str, kinds: Mapping[str, str], by_type: Mapping[str, Iterable[str]]) -> str:
    """For rows where a value may have the wrong type: ``, key: TYPE, key: TYPE`` of the top level.

    Only known keys are listed, each with the head of its type (OBJECT, ARRAY, STRING ..), so nothing
    below the top level is looked at. Text that is no object reads as anything that
    does not start with a comma. NULL for all other rows, which are not parsed again.
    """
    opening = {"str": '"', "obj": "{"}
    branches = ""
    for condition, names in by_type.items():
        tests = [_plain(text, n, opening[kinds[n]]) for n in names if kinds[n] in opening]
        branches += f" when {condition} then {' and '.join(tests) or 'true'}"
    listed = ", ".join(f"'{n}'" for n in sorted({n for names in by_type.values() for n in names}))
    members = f"map_entries(try_cast(try_parse_json({text}) as map<string, variant>))"
    known = f"array_sort(filter({members}, e -> e.key in ({listed})), (l, r) -> case when l.key < r.key then -1 when l.key > r.key then 1 else 0 end)"
    head = r"regexp_extract(schema_of_variant(e.value), '^[A-Z]+([(][0-9,]+[)])?', 0)"
    types = f"concat(', ', array_join(transform({known}, e -> concat(e.key, ': ', {head})), ', '))"
    return (
        f"case when {text} is not null and ({parsed}.__bad is not null or contains({text}, '\\\\') or not case{branches} else true end)"
        f" then coalesce({types}, 'none') end"
    )


def _plain(text: str, name: str, opening: str) -> str:
    """The quoted key is not in the text at all, or once and before a value of the right type.

    Then no other place can be taken for it: not a nested or repeated key, and not an escaped one, as text with a backslash is
    suspect anyway. ``locate`` would count characters from the start of the text each time; these tests compare bytes.
    """
    key = f"""'"{name}"'"""
    once = f"""contains({text}, '"{name}":{opening}') and substring_index({text}, {key}, 2) = {text}"""
    return f"(not contains({text}, {key}) or {once})"


def uint64_field(text: str, parsed: str, suspect: str, name: str) -> str:
    """An unsigned 64-bit field read as BIGINT; values beyond that are looked up again, exactly."""
    again = f"try_variant_get(try_parse_json({text}), '$.{name}', 'decimal(20,0)')"
    return f"coalesce(cast({parsed}.`{name}` as decimal(20,0)), case when {suspect} is not null then {again} end)"


def _pattern(kinds: Mapping[str, str], names: Iterable[str]) -> str:
    """Matches a listed key whose type does not fit; group 1 is the key."""
    by_kind: dict[str, list[str]] = {}
    for name in names:
        by_kind.setdefault(kinds[name], []).append(name)
    misfits = "|".join(f"(?=(?:{'|'.join(keys)}): (?!VOID|{_FITS[kind]}))" for kind, keys in by_kind.items())
    return f", (?:{misfits})([^:]+):"


def wrong_kind(types: str, kinds: Mapping[str, str], by_type: Mapping[str, Iterable[str]], otherwise: str) -> str:
    """First key (by name) with the wrong JSON type, NULL if there is none; ``otherwise`` if the text is no object.

    ``types`` is a column made by ``suspect_kinds``; ``by_type`` maps an SQL
    condition to the keys that count under it.
    """
    branches = " ".join(f"when {cond} then r'{_pattern(kinds, names)}'" for cond, names in by_type.items())
    return (
        f"case when not startswith({types}, ', ') then '{otherwise}'"
        f" when {types} is not null then nullif(regexp_extract({types}, case {branches} end, 1), '') end"
    )
