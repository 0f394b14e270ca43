"""The audit trail: one row per table and cleaning step.

Each step leaves yes/no columns behind (see :mod:`.edits`).  They are counted
where every row passes once, while the table is written or by one aggregate,
and the few counts of a table are spelt out as step rows.

Fixed values: the step names.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.functions.numbers import count_where
from tallygrove.operators import impute, references, standardise
from tallygrove.operators.dedup import is_tagged
from tallygrove.operators.edits import Edit
from tallygrove.rules import CleaningRules
from tallygrove.sources.csv_dir import RESCUED

DEDUP = "deduplication"

TEXTS = {
    "tagged": "%d rows dropped whose key has the duplicate tag",
    "longer": "%d rows had more fields than the header",
    "repeated": "%d rows dropped that repeat the key of an earlier one: ",
    "failed": "{c}: %d texts are no date, now NULL",
    "parsed": "{c}: %d values are dates now",
    "changed": "{c}: %d spellings replaced",
    "unmapped": "{c}: %d texts have no standard spelling: %s",
    "outside": "{c}: %d values outside {low} to {high}, now NULL",
    "median": "{c}: %d gaps got the median %s",
    "mode": "{c}: %d gaps got the most frequent value '%s'",
    "unknown": "{c}: %d gaps got the text Unknown",
    "zero": "{c}: %d gaps got 0",
    "skip": "{c}: %d gaps left as they are",
    "orphan": "{c}: %d references without a parent, now NULL",
    "int": "{c}: now bigint",
    "float": "{c}: now double",
}

AUDIT_SCHEMA = (
    "table_name string, step_no int, step string, rows_before bigint, "
    "rows_after bigint, rows_affected bigint, details string"
)


Row = tuple[str, int, str, int, int, int, str]


class _Say(NamedTuple):
    """A remark of a step: the text of a measure, told with the count of a flag."""

    measure: str
    flag: str
    column: str = ""
    words: Mapping[str, object] = {}
    more: tuple[str, ...] = ()
    # Told also where the count is zero.
    always: bool = False

    def told(self, n: int) -> str | None:
        if n or self.always:
            return TEXTS[self.measure].format(c=self.column, **self.words) % (n, *self.more)
        return None


class _Step(NamedTuple):
    name: str
    # Flags whose counts add up to the changed rows, or the number of columns that the step is about.
    affected: list[str] | int
    says: list[_Say | str]


class TableAudit:
    """Collects the steps of one table and turns their counts into audit rows."""

    def __init__(self, table: str, raw: DataFrame, pk: str, rules: CleaningRules):
        self.table, self.raw, self.pk, self.rules = table, raw, pk, rules
        self.flags: list[str] = []
        self.unmapped: Callable[[], DataFrame] | None = None
        self.steps: list[_Step] = []

    def _flag(self, edit: Edit, measure: str) -> str:
        name = edit.flag_name(measure)
        self.flags.append(name)
        return name

    def dates(self, edits: Sequence[Edit]) -> None:
        says = []
        for e in edits:
            says.append(_Say("failed", self._flag(e, "failed"), e.column))
            says.append(_Say("parsed", self._flag(e, "parsed"), e.column, always=True))
        # This step reports columns, not rows.
        self.steps.append(_Step(standardise.DATES, len(edits), says))

    def categories(self, edits: Sequence[Edit], unmapped: Callable[[], DataFrame]) -> None:
        self.unmapped = unmapped if edits else None
        flags, says = [], []
        for e in edits:
            flags.append(self._flag(e, "changed"))
            # The unmapped texts of a column follow its count.
            says += [_Say("changed", flags[-1], e.column), e.column]
        self.steps.append(_Step(standardise.CATEGORIES, flags, says))

    def outliers(self, edits: Sequence[Edit]) -> None:
        flags, says = [], []
        for e in edits:
            low, high = self.rules.bounds[e.column]
            flags.append(self._flag(e, "outside"))
            words = {"low": low, "high": "inf" if high is None else high}
            says.append(_Say("outside", flags[-1], e.column, words))
        self.steps.append(_Step(standardise.OUTLIERS, flags, says))

    def fills(self, edits: Sequence[Edit]) -> None:
        flags, says = [], []
        for e in edits:
            (measure,) = e.flags
            if measure in ("median", "mode") and e.note is None:
                # Nothing is filled where the column has no value to fill with.
                continue
            flag = self._flag(e, measure)
            if measure != "skip":
                flags.append(flag)
            says.append(_Say(measure, flag, e.column, more=() if e.note is None else (e.note,)))
        self.steps.append(_Step(impute.STEP, flags, says))

    def reference(self, column: str, flag: str) -> None:
        self.flags.append(flag)
        self.steps.append(_Step(references.STEP, [flag], [_Say("orphan", flag, column)]))

    def types(self, edits: Sequence[Edit]) -> None:
        texts = []
        for e in edits:
            for kind, columns in (("int", self.rules.integer_columns), ("float", self.rules.float_columns)):
                if e.column in columns:
                    texts.append(_Say(kind, "", e.column))
                    break
        self.steps.append(_Step(standardise.TYPES, len(texts), texts))

    def measures(self) -> list[Column]:
        """The counts of all steps and of the rows that are left."""
        flags = [count_where(F.col(f)).alias(f) for f in dict.fromkeys(self.flags)]
        return [F.count(F.lit(1)).alias("__rows"), *flags]

    def before(self) -> dict:
        """What the table had before: counts of rows, and unmapped texts by column.

        One row, and one for each column with a list of texts.
        """
        tagged = count_where(is_tagged(self.pk, self.rules.duplicate_tag))
        longer = F.count(F.col(RESCUED)) if RESCUED in self.raw.columns else F.lit(0)
        counts = self.raw.agg(F.count("*").alias("n"), tagged.alias("tagged"), longer.alias("longer")).first()
        texts = self.unmapped().collect() if self.unmapped else []
        return {**counts.asDict(), "unmapped": {r.column_name: (r.n_unmapped, r.sample) for r in texts}}

    def rows(self, found: Mapping[str, int], before: Mapping) -> list[Row]:
        """The audit rows from the ``measures`` and from what was ``before``."""
        after, repeated = found["__rows"], before["n"] - before["tagged"] - found["__rows"]
        keys = [c for c in self.rules.match_keys.get(self.table, ()) if c in self.raw.columns]
        says = [
            _Say("longer", "").told(before["longer"]),
            _Say("tagged", "").told(before["tagged"]),
            TEXTS["repeated"] % repeated + str(keys) if repeated else None,
        ]
        out = [(self.table, 1, DEDUP, before["n"], after, before["n"] - after, _joined(says))]
        for number, step in enumerate(self.steps, start=2):
            affected = step.affected if isinstance(step.affected, int) else sum(found[f] for f in step.affected)
            told = []
            for say in step.says:
                if isinstance(say, str):
                    n, sample = before["unmapped"].get(say, (0, []))
                    quoted = ", ".join(f"'{v}'" for v in sample)
                    told.append(TEXTS["unmapped"].format(c=say) % (n, f"[{quoted}]") if n else None)
                elif say.measure in ("int", "float"):
                    told.append(TEXTS[say.measure].format(c=say.column))
                else:
                    told.append(say.told(found[say.flag]))
            out.append((self.table, number, step.name, after, after, affected, _joined(told)))
        return out


def _joined(texts: Sequence[str | None]) -> str:
    return " | ".join(t for t in texts if t is not None)


def summarise(audit: DataFrame) -> DataFrame:
    """Per table: rows before and after, all changes, number of steps."""
    return audit.groupBy("table_name").agg(
        F.min_by("rows_before", "step_no").alias("initial_rows"),
        F.max_by("rows_after", "step_no").alias("final_rows"),
        F.sum("rows_affected").alias("total_changes"),
        F.count("*").alias("n_steps"),
    )
