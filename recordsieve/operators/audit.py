"""NULLs per column before and after coercion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.specs import RAW, RecordSpec


def null_audit(
    df: DataFrame, columns: Mapping[str, tuple[str, str]], by: Sequence[str] = ()
) -> DataFrame:
    """``columns`` maps a name to the SQL of its (raw, typed) value.

    One pass for all columns: two counters per column, combined per task before
    anything is shuffled. A rise of the count means values were unreadable.
    """
    return _audit(df, {name: (f"({raw}) IS NULL", f"({typed}) IS NULL") for name, (raw, typed) in columns.items()}, by)


def staged_audit(rows: DataFrame, spec: RecordSpec, by: Sequence[str] = ()) -> DataFrame:
    """The same of ``staged`` rows, whose values are coerced already: bits and NULLs are counted, nothing is read twice."""
    tests = {
        name: (f"(missing & {1 << i}L) <> 0", f"out.`{name}` IS NULL")
        for i, (name, group) in enumerate(spec.columns)
        if group != RAW
    }
    return _audit(rows.where("out IS NOT NULL"), tests, by)


def _audit(df: DataFrame, tests: Mapping[str, tuple[str, str]], by: Sequence[str]) -> DataFrame:
    counters = []
    for name, (before, after) in tests.items():
        counters.append(F.expr(f"count_if({before}) AS `{name}__before`"))
        counters.append(F.expr(f"count_if({after}) AS `{name}__after`"))
    rows = ", ".join(
        f"struct('{name}' AS col, `{name}__before` AS nulls_before, `{name}__after` AS nulls_after)" for name in tests
    )
    return df.groupBy(*by).agg(*counters).selectExpr(*by, f"inline(array({rows}))")
