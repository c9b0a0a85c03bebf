"""JSON line -> record struct, strict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.functions.names import unused
from recordsieve.functions.text import strip
from recordsieve.specs import BAD_LINES

_OPTIONS = {"allowSingleQuotes": "false"}


def record_type(fields: Sequence[str]) -> str:
    """All fields are STRING: one wrongly typed value would otherwise void the
    whole record."""
    return "struct<" + ",".join(f"`{name}`:string" for name in fields) + ">"


def parse_records(
    lines: DataFrame,
    fields: Sequence[str],
    line: str = "line",
    into: str = "record",
    stripped: bool = False,
) -> DataFrame:
    """Add ``into``, a struct of STRING ``fields``; NULL for a bad line.

    Every input row comes out once.

    ``from_json`` alone ignores what follows the first value. So the line is
    put into an envelope whose end mark must be found again: the mark is a hash
    of the line, which a line cannot sensibly contain itself.

    The parse is a projection, which is compiled; a generator would interpret it.
    Its result goes through a generator, whose output is a plain attribute to
    the optimizer, so no later filter or projection can repeat the parse.
    """
    if not stripped:
        lines = lines.withColumn(line, F.expr(strip(line)))
    text = F.col(line)
    end = F.xxhash64(text).cast("string")
    envelope = F.from_json(
        F.concat(F.lit('{"r":['), text, F.lit('],"end":"'), end, F.lit('"}')),
        f"struct<r:array<{record_type(fields)}>,end:string>",
        _OPTIONS,
    )

    name = unused("envelope", [*lines.columns, into])
    records = F.col(name)["r"]
    whole = (
        text.startswith("{")
        & (F.col(name)["end"] == end)
        & (F.size(records) == 1)
        & records[0].isNotNull()
    )
    parsed = lines.withColumn(name, envelope).withColumn(name, F.when(whole, records))
    return parsed.select("*", F.explode_outer(name).alias(into)).drop(name)


def parse_where(
    df: DataFrame, condition: str, fields: Sequence[str], line: str = "line", into: str = "record"
) -> DataFrame:
    """Like ``parse_records`` for lines known to be good, only where
    ``condition`` holds; ``into`` is NULL elsewhere and nothing is parsed."""
    record = F.from_json(F.col(line), record_type(fields), _OPTIONS)
    return df.select("*", F.explode_outer(F.when(F.expr(condition), F.array(record))).alias(into))


def parse_status(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn(
        "parse_status",
        F.when(F.col("record").isNull(), F.lit(BAD_LINES)).otherwise("ok"),
    )
