"""Presence, truthiness and equality tests on raw record fields.

The STRING fields of a parsed record have lost their quote marks, so JSON
``true`` and ``"true"`` look alike. Given the line, the tests tell them apart.
The second look is only taken at the few values where it matters, as CASE arms
are lazy.
"""

from __future__ import annotations

from recordsieve.functions.coerce import FALSY_JSON, number


def quoted(line: str, field: str, text: str) -> str:
    """Whether ``field`` of a JSON line, which reads as ``text``, is a string.

    Read once more with the type the text suggests, a string gives NULL.
    """

    def unreadable(dtype: str) -> str:
        return f"from_json({line}, 'struct<`{field}`:{dtype}>').`{field}` IS NULL"

    return (
        f"CASE WHEN {text} IN ('true', 'false') THEN {unreadable('boolean')}"
        f" WHEN {text} = '[]' THEN {unreadable('array<string>')}"
        f" WHEN {text} = '{{}}' THEN {unreadable('map<string,string>')}"
        f" ELSE {unreadable('double')} END"
    )


def present(c: str) -> str:
    return f"{c} IS NOT NULL"


def is_true(c: str, is_quoted: str = "false") -> str:
    """True for ``true`` and any spelling of the number 1."""
    return (
        f"CASE WHEN {c} IS NULL OR {c} IN ('false', '0') THEN false"
        f" WHEN {c} IN ('true', '1') OR ({number(c)}) = 1D THEN NOT ({is_quoted})"
        f" ELSE false END"
    )


def truthy(c: str, is_quoted: str = "false") -> str:
    """True for all but null, false, 0, '' and empty arrays or objects."""
    return (
        f"CASE WHEN {c} IS NULL OR {c} = '' THEN false WHEN {c} = 'true' THEN true"
        # "0" or "false" as a JSON string is truthy
        f" WHEN {c} IN {FALSY_JSON} OR ({number(c)}) = 0D THEN {is_quoted}"
        f" ELSE true END"
    )
