"""The ordered reject rules: the first that matches names the reason."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recordsieve.functions import truth
from recordsieve.functions.coerce import exact_json
from recordsieve.functions.text import key_of
from recordsieve.operators.membership import flag_members
from recordsieve.operators.parse import parse_records, parse_where
from recordsieve.specs import BAD_LINES, BOTS, DELETED_AUTHOR, JSON, OFF_TOPIC, RecordSpec, Rule


def rule_test(rule: Rule, source: str = "record", line: str | None = None) -> str:
    """SQL test of one rule. With ``line``, quoted look-alikes are told apart."""

    def one(field: str) -> str:
        value = f"{source}.`{field}`" if source else f"`{field}`"
        if rule.test == "present":
            return truth.present(value)
        test = getattr(truth, rule.test)
        return test(value, truth.quoted(line, field, value)) if line else test(value)

    return " OR ".join(f"({one(field)})" for field in rule.fields)


def first_reason(arms: list[tuple[str, str]]) -> str:
    """CASE over (test, reason) pairs; NULL when no rule matches (kept)."""
    return "CASE " + " ".join(f"WHEN {test} THEN '{reason}'" for test, reason in arms) + " END"


def judge(
    lines: DataFrame,
    spec: RecordSpec,
    topics: DataFrame,
    bots: DataFrame,
    stripped: bool = False,
) -> DataFrame:
    """Decide every line: adds ``subreddit`` (key), ``reason`` and ``record``.

    ``reason`` is NULL for kept lines, ``record`` only filled for them, so the
    result is small to store. ``subreddit`` is NULL for bad lines. All other
    columns are carried along; the line itself is dropped.

    Every line is scanned for its two list keys. Only lines that pass the lists,
    usually few, are parsed in full.
    """
    carried = [c for c in lines.columns if c != "line"]
    keys = parse_records(lines, ("subreddit", "author"), into="head", stripped=stripped).selectExpr(
        *carried,
        "line",
        "head IS NULL AS is_bad",
        f"CASE WHEN head IS NOT NULL THEN {key_of('head.subreddit')} END AS subreddit",
        f"CASE WHEN head IS NOT NULL THEN {key_of('head.author')} END AS author_key",
    )
    flagged = flag_members(keys, "subreddit", topics, "on_topic")
    flagged = flag_members(flagged, "author_key", bots, "is_listed")
    is_bot = f"(is_listed OR author_key = '{DELETED_AUTHOR}')"
    full = parse_where(flagged, f"on_topic AND NOT {is_bot}", spec.input_fields)
    reason = first_reason(
        [
            ("is_bad", BAD_LINES),
            ("NOT on_topic", OFF_TOPIC),
            (is_bot, BOTS),
            *((rule_test(rule, line="line"), rule.reason) for rule in spec.rules),
        ]
    )
    judged = full.selectExpr(*carried, "line", "subreddit", f"{reason} AS reason", "record")
    # While the line is at hand: nested values become exact JSON text, in which "0" is no 0.
    exact = {name: exact_json("line", name, f"record.`{name}`") for name in spec.group(JSON)}
    kept = ", ".join(f"{exact.get(name, f'record.`{name}`')} AS `{name}`" for name in spec.names)
    return judged.selectExpr(*carried, "subreddit", "reason", f"CASE WHEN reason IS NULL THEN struct({kept}) END AS record")
