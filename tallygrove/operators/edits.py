"""Column edits: a new value for one column plus the counts its audit needs.

A cleaning step is a list of edits.  All edits of a step read the table as it
was before the step, so they become one projection, and the yes/no columns an
audit counts ride along in the same projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

FLAG_PREFIX = "__"


@dataclass(frozen=True)
class Edit:
    step: str
    column: str
    value: Column
    flags: Mapping[str, Column] = field(default_factory=dict)
    # A single value worth reporting, such as the fill.
    note: str | None = None

    def flag_name(self, measure: str) -> str:
        return f"{FLAG_PREFIX}{self.step}__{self.column}__{measure}"


def apply_edits(df: DataFrame, edits: Iterable[Edit], keep_flags: bool = False) -> DataFrame:
    columns: dict[str, Column] = {}
    for edit in edits:
        columns[edit.column] = edit.value
        if keep_flags:
            for measure, condition in edit.flags.items():
                columns[edit.flag_name(measure)] = condition
    return df.withColumns(columns) if columns else df


def drop_flags(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith(FLAG_PREFIX)])
