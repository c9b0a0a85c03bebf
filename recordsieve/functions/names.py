"""Column names that clash with none of a table's own."""

from __future__ import annotations

from collections.abc import Iterable


def unused(name: str, taken: Iterable[str]) -> str:
    """``name``, or name_2, name_3, ... if a column is called so (in any case) already."""
    used, n, found = {c.lower() for c in taken}, 1, name
    while found.lower() in used:
        n, found = n + 1, f"{name}_{n + 1}"
    return found
