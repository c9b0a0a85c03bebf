"""Raw text -> typed value. Anything unreadable becomes NULL, never an error.

Inputs are the STRING fields of a parsed record: JSON numbers and booleans
arrive as their text, JSON strings without quotes, nested values as JSON text.
"""

from __future__ import annotations

from recordsieve.functions.text import literal

# Spark's own casts also take '1d', '1f', 'nan' and 'inf', so guard them.
_SPACE = "[ \t\n\x0b\f\r]*"
NUMBER = literal(f"^{_SPACE}[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?{_SPACE}$")

# Seconds that fit a 64-bit nanosecond clock (years 1677-2262).
EPOCH_LIMIT = 9223372036

# JSON texts of falsy values.
FALSY_JSON = "('', '0', '-0', '0.0', '-0.0', 'false', '[]', '{}')"


def number(c: str) -> str:
    """Numeric text as DOUBLE."""
    return f"CASE WHEN {c} RLIKE {NUMBER} THEN try_cast({c} AS DOUBLE) END"


def to_double(c: str) -> str:
    return f"CASE {c} WHEN 'true' THEN 1D WHEN 'false' THEN 0D ELSE {number(c)} END"


def to_bigint(c: str) -> str:
    """Whole numbers, also written as 4.0 or 1e3; exact up to 64 bits."""
    # The plain cast settles nearly all values; the rest is not evaluated then.
    d = f"({to_double(c)})"
    return (
        f"coalesce(try_cast({c} AS BIGINT),"
        f" CASE WHEN {d} = floor({d}) AND abs({d}) < 9.2233720368547758E18D"
        f" THEN try_cast({d} AS BIGINT) END)"
    )


def to_boolean(c: str) -> str:
    return (
        f"CASE {c} WHEN 'true' THEN true WHEN 'false' THEN false"
        f" ELSE CASE ({number(c)}) WHEN 1D THEN true WHEN 0D THEN false END END"
    )


def to_timestamp(c: str) -> str:
    """Epoch seconds, fractions kept."""
    whole, any_number = f"try_cast({c} AS BIGINT)", f"({number(c)})"
    limits = f"BETWEEN -{EPOCH_LIMIT} AND {EPOCH_LIMIT}"
    return (
        f"CASE WHEN {whole} {limits} THEN timestamp_seconds({whole})"
        f" WHEN {any_number} {limits} THEN timestamp_seconds({any_number}) END"
    )


def _json_string(c: str) -> str:
    wrapped = f"to_json(struct({c} AS v))"
    return f"substring({wrapped}, 6, length({wrapped}) - 6)"


def _like_json(c: str) -> str:
    """Whether the text of a field could be that of a JSON value other than a string."""
    return f"(startswith({c}, '[') OR startswith({c}, '{{') OR {c} IN ('true', 'false') OR {c} RLIKE {NUMBER})"


def to_json_text(c: str) -> str:
    """JSON text of a nested value; every falsy value gives the text ``null``."""
    # A plain JSON string has lost its quotes on the way in: put them back.
    return (
        f"CASE WHEN {c} IS NULL OR {c} IN {FALSY_JSON} THEN 'null'"
        f" WHEN startswith({c}, '[') OR startswith({c}, '{{')"
        f" OR {c} = 'true' OR {c} RLIKE {NUMBER} THEN {c}"
        f" ELSE {_json_string(c)} END"
    )


def is_json_string(line: str, field: str, c: str) -> str:
    """Whether ``field`` of a JSON line, which reads as ``c``, is a string, by the type it has as a VARIANT.

    The line is only parsed again where the field's name is followed by a quote. A line that VARIANT does not take (a
    repeated key, NaN) is told by reading the field as the type its text suggests, see ``truth.quoted``.
    """
    from recordsieve.functions.truth import quoted

    kind = f"schema_of_variant(try_variant_get(try_parse_json({line}), '$.{field}', 'variant'))"
    follows = literal(f'"{field}"[ \t\r\n]*:[ \t\r\n]*"')
    return f"CASE WHEN {line} RLIKE {follows} THEN coalesce({kind} = 'STRING', {quoted(line, field, c)}) ELSE false END"


def exact_json(line: str, field: str, c: str) -> str:
    """JSON text of a field, strings with their quotes; NULL where there is no value."""
    return (
        f"CASE WHEN {c} IS NULL THEN CAST(NULL AS STRING) WHEN NOT {_like_json(c)} THEN {_json_string(c)}"
        f" WHEN {is_json_string(line, field, c)} THEN {_json_string(c)} ELSE {c} END"
    )


def truthy_json(c: str) -> str:
    """Exact JSON text, with ``null`` for every falsy value: null, 0, false, and empty strings, arrays and objects."""
    empty = FALSY_JSON.replace("''", "'\"\"'")
    return f"CASE WHEN {c} IS NULL OR {c} IN {empty} OR ({number(c)}) = 0D THEN 'null' ELSE {c} END"
