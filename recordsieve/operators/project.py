"""Declared output columns: projection and type coercion in one select."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.functions import coerce as to
from recordsieve.functions import text
from recordsieve.functions.names import unused
from recordsieve.specs import (
    BIGINT, BOOLEAN, DOUBLE, ENUM, JSON, RAW, STRING, TEXT, TIMESTAMP, RecordSpec,
)

COERCIONS = {
    RAW: lambda c: c,
    STRING: text.fill,
    TEXT: text.flatten_text,
    ENUM: lambda c: text.fill(c, "none"),
    TIMESTAMP: to.to_timestamp,
    BOOLEAN: to.to_boolean,
    BIGINT: to.to_bigint,
    DOUBLE: to.to_double,
    JSON: to.to_json_text,
}


def typed_columns(
    spec: RecordSpec, source: str = "", null_text: str = "", exact: bool = False
) -> dict[str, tuple[str, str]]:
    """Output name -> SQL of the (raw, typed) value; raw fields are STRING
    columns, or the fields of struct ``source``. With ``exact``, nested values
    are JSON text already, as ``judge`` leaves them."""
    out = {}
    for name, group in spec.columns:
        raw = f"{source}.`{name}`" if source else f"`{name}`"
        typed = text.flatten_text(raw, null_text) if group == TEXT else COERCIONS[group](raw)
        if exact and group == JSON:
            typed = to.truthy_json(raw)
        out[name] = raw, typed
    return out


def coerce(
    df: DataFrame,
    spec: RecordSpec,
    source: str = "",
    keep: Sequence[str] = (),
    null_text: str = "",
    exact: bool = False,
) -> DataFrame:
    """Typed output of ``spec``, after the ``keep`` columns. Drops no row.

    ``null_text`` is what a NULL in a text column becomes: '' by default,
    'None' for what plain string conversion in Python would give.
    """
    columns = typed_columns(spec, source, null_text, exact)
    return df.selectExpr(*keep, *(f"{typed} AS `{name}`" for name, (_, typed) in columns.items()))


def staged(judged: DataFrame, spec: RecordSpec, null_text: str = "") -> DataFrame:
    """Judged rows with their typed values, in the place of ``record``; each value is coerced once.

    ``out`` has the typed columns (NULL for lines that are not kept), ``rejected`` the raw values that could not be
    converted, by column, and ``missing`` a bit for each column, in the order of the spec, that had no value.
    """
    columns = typed_columns(spec, "record", null_text, exact=True)
    typed = ", ".join(f"{value} AS `{name}`" for name, (_, value) in columns.items())
    # A projection is compiled; a generator would interpret the coercions. It only passes their result on: its output is a
    # plain attribute, so what follows cannot repeat them.
    name = unused("coerced", judged.columns)
    out = judged.withColumn(name, F.expr(f"CASE WHEN record IS NOT NULL THEN struct({typed}) END"))
    out = out.select("*", F.explode(F.array(name)).alias("out"))
    lost = ", ".join(
        f"CASE WHEN {columns[name][0]} IS NOT NULL AND out.`{name}` IS NULL"
        f" THEN struct('{name}' AS col, {columns[name][0]} AS value) END"
        for name in spec.group(TIMESTAMP, BOOLEAN, BIGINT, DOUBLE)
    )
    bits = " + ".join(
        f"CASE WHEN {raw} IS NULL THEN {1 << i}L ELSE 0L END" for i, (raw, _) in enumerate(columns.values())
    )
    return out.selectExpr(
        *(f"`{c}`" for c in judged.columns if c != "record"),
        "out",
        f"CASE WHEN out IS NOT NULL THEN array_compact(array({lost})) END AS rejected",
        f"CASE WHEN out IS NOT NULL THEN {bits} END AS missing",
    )


def rejected_values(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(..., id, col, value): the raw values of kept records that could not be converted, of ``staged`` rows."""
    return rows.where("size(rejected) > 0").selectExpr(*keep, "out.id AS id", "inline(rejected)")
