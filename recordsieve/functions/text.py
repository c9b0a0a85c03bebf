"""String helpers.

All functions of this package take and return SQL text over built-in functions.
A projection of some fifty coerced columns is then a short list of strings,
not thousands of calls into the JVM.
"""

from __future__ import annotations

# The characters Python's str.strip() takes off.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def literal(value: str) -> str:
    """SQL string literal; the values used here have no backslash."""
    assert "\\" not in value
    return "'" + value.replace("'", "''") + "'"


def strip(c: str) -> str:
    """Trim Unicode whitespace at both ends (plain ``trim`` takes spaces only)."""
    return f"btrim({c}, {literal(WHITESPACE)})"


def key_of(c: str) -> str:
    """Lookup key of a field: lower case, missing counts as ''."""
    return f"lower(coalesce({c}, ''))"


def flatten_newlines(c: str) -> str:
    """Each newline or carriage return becomes one space."""
    return f"replace(replace({c}, char(10), ' '), char(13), ' ')"


def fill(c: str, default: str = "") -> str:
    return f"coalesce({c}, {literal(default)})"


def flatten_text(c: str, null_text: str = "") -> str:
    return fill(flatten_newlines(c), null_text)


def base_name(path: str) -> str:
    """File name without its last extension; a leading dot starts no extension."""
    return f"regexp_replace(substring_index({path}, '/', -1), '(?s)^([.]*[^.].*)[.][^.]*$', '$1')"
