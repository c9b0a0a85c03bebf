"""Clean one set of lines: judge, count, audit, coerce."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from recordsieve.operators import stats
from recordsieve.operators.audit import null_audit
from recordsieve.operators.cascade import judge
from recordsieve.operators.project import coerce, typed_columns
from recordsieve.session import written
from recordsieve.specs import RAW, RecordSpec


@dataclass(frozen=True)
class Cleaned:
    """Results over judged lines; all lazy, each over the columns it needs."""

    judged: DataFrame
    spec: RecordSpec
    by: tuple[str, ...]
    null_text: str = ""

    @property
    def kept_raw(self) -> DataFrame:
        return self.judged.where("reason IS NULL")

    @cached_property
    def kept(self) -> DataFrame:
        return coerce(self.kept_raw, self.spec, "record", self.by, self.null_text, exact=True)

    @cached_property
    def cells(self) -> DataFrame:
        return stats.cells(self.judged, self.by)

    @property
    def audit(self) -> DataFrame:
        columns = typed_columns(self.spec, "record", self.null_text, exact=True)
        coerced = {name: columns[name] for name, group in self.spec.columns if group != RAW}
        return null_audit(self.kept_raw, coerced, self.by)


def clean(
    lines: DataFrame,
    spec: RecordSpec,
    topics: DataFrame,
    bots: DataFrame,
    by: Sequence[str] = (),
    stripped: bool = False,
    null_text: str = "",
    store: str | None = None,
) -> Cleaned:
    """Apply ``spec`` to a DataFrame with a ``line`` column.

    ``store`` is a path for the judged lines. Give it when more than one result
    is wanted: lines are then parsed once, and an executor lost later costs no
    second read of the dumps.
    """
    judged = judge(lines, spec, topics, bots, stripped)
    if store:
        judged = written(judged, store)
    return Cleaned(judged, spec, tuple(by), null_text)
