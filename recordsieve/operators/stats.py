"""Statistics of a cleaning run.

One shuffle: judged lines are counted per (file, subreddit, reason) with
partial aggregation before it, so a hot subreddit costs no more than a rare
one. All reports are roll-ups of these few ``cells``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.specs import OFF_TOPIC

BY_FILE = ("kind", "base_name")


def cells(judged: DataFrame, by: Sequence[str] = BY_FILE) -> DataFrame:
    return judged.groupBy(*by, "subreddit", "reason").agg(F.expr("count(*) AS n"))


def seeded(cells: DataFrame, files: DataFrame, by: Sequence[str] = BY_FILE) -> DataFrame:
    """With a count of 0 for every file, so that one without lines is in the totals, the reasons and the report."""
    nothing = files.selectExpr(*by, "CAST(NULL AS STRING) AS subreddit", "CAST(NULL AS STRING) AS reason", "0L AS n")
    return cells.unionByName(nothing)


def _sum(name: str, condition: str = "true"):
    return F.expr(f"coalesce(sum(CASE WHEN {condition} THEN n END), 0) AS `{name}`")


def totals(cells: DataFrame, by: Sequence[str] = BY_FILE) -> DataFrame:
    """Lines read, kept and rejected.

    Coercion drops no row, so processed = written = kept. The legacy count of
    rows lost in coercion is therefore always 0; ``n_filtered`` is the count
    of rejected lines.
    """
    return cells.groupBy(*by).agg(
        _sum("n_read"),
        _sum("n_processed", "reason IS NULL"),
        _sum("n_written", "reason IS NULL"),
        _sum("n_filtered", "reason IS NOT NULL"),
        F.expr("0L AS n_filtered_legacy"),
    )


def by_reason(cells: DataFrame, reasons: Sequence[str], by: Sequence[str] = BY_FILE) -> DataFrame:
    """Lines per reject reason, zero-filled over ``reasons``."""
    wide = cells.groupBy(*by).agg(*(_sum(r, f"reason = '{r}'") for r in reasons))
    rows = ", ".join(f"struct('{r}' AS reason, `{r}` AS n)" for r in reasons)
    return wide.selectExpr(*by, f"inline(array({rows}))")


def by_group(cells: DataFrame, by: Sequence[str] = BY_FILE) -> DataFrame:
    """Lines per subreddit: all parsed, on topic, and kept.

    ``n_topic`` is taken before the author and later rules.
    """
    return (
        cells.where("subreddit IS NOT NULL")
        .groupBy(*by, "subreddit")
        .agg(
            _sum("n_all"),
            _sum("n_topic", f"reason IS DISTINCT FROM '{OFF_TOPIC}'"),
            _sum("n_kept", "reason IS NULL"),
        )
    )


def report_lines(cells: DataFrame, reasons: Sequence[str], by: Sequence[str] = BY_FILE) -> DataFrame:
    """The report as text rows (``section``, ``rank``, ``line``) per file.

    Sorting by section, rank (descending) and line gives the printed order.
    Subreddits are listed by count, then name.
    """

    def row(section: int, line: str, rank: str = "0L") -> str:
        return f"struct({section} AS section, {rank} AS rank, {line} AS line)"

    # Wording of the report.
    head = [
        "'Total lines read: ' || n_read",
        "'Total lines processed: ' || n_kept",
        "'Total lines kept for analysis: ' || n_kept",
        "'Total lines filtered out: 0'",
        *(f"'Lines filtered out due to {r.replace('_', ' ')}: ' || `{r}`" for r in reasons),
    ]
    all_heading = "'Subreddit counts (including filtered lines):'"
    topic_heading = "'Subreddit counts (lines kept for analysis):'"

    sums = cells.groupBy(*by).agg(
        _sum("n_read"),
        _sum("n_kept", "reason IS NULL"),
        *(_sum(r, f"reason = '{r}'") for r in reasons),
    )
    fixed = [row(i, line) for i, line in enumerate(head)]
    fixed += [row(50, "''"), row(51, all_heading), row(60, "''"), row(61, topic_heading)]
    listed = [
        row(52, "subreddit || ': ' || n_all", "n_all"),
        row(62, "subreddit || ': ' || n_topic", "n_topic"),
    ]
    top = sums.selectExpr(*by, f"inline(array({', '.join(fixed)}))")
    groups = by_group(cells, by).selectExpr(*by, f"inline(array({', '.join(listed)}))")
    # Off-topic groups have no line in the second list.
    return top.unionByName(groups.where("section = 52 OR rank > 0"))
