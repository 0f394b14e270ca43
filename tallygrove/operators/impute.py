"""Filling missing values: exact medians by sketch and bracket, modes from counts; no hot task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.functions.numbers import count_where
from tallygrove.operators.edits import Edit, apply_edits
from tallygrove.operators.standardise import number_of
from tallygrove.rules import DEFAULT_RULES, CleaningRules

STEP = "imputation"
UNKNOWN = "Unknown"

# Distinct values that one task may order at most.
MOST_ORDERED = 100_000
# The relative rank error of the sketch is the inverse of this.
ACCURACY = 10_000


def _cells(df: DataFrame, columns: Sequence[str], number: bool) -> DataFrame:
    """(column_name, value, gap) per cell that has a value or is missing.

    A text that is no number has no value, yet is not a gap.
    """
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            (number_of(df, c) if number else F.col(c).cast("string")).alias("value"),
            F.col(c).isNull().alias("gap"),
        )
        for c in columns
    ]
    return df.select(F.inline(F.array(*cells))).filter("gap or value is not null")


def _value_counts(df: DataFrame, columns: Sequence[str], number: bool) -> DataFrame:
    """Rows per (column_name, value); the gaps of a column are a row without value."""
    return (
        _cells(df, columns, number)
        .groupBy("column_name", "value")
        .agg(F.count("value").alias("n"), F.bool_or("gap").alias("gap"))
    )


@dataclass
class _Search:
    """The middle ranks of a column that are still open, between two values of the column.

    Both ends are values whose ranks are known, or infinite at first.  ``below``
    counts the rows up to and including the lower end.
    """

    column: str
    value: Column
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    rows: int = 0
    inside: int = 0
    distinct: int = 0
    has_gap: bool = False
    open: list[int] = field(default_factory=list)
    found: dict[int, float] = field(default_factory=dict)

    def between(self) -> Column:
        return (self.value > F.lit(self.low)) & (self.value < F.lit(self.high))

    def shares(self) -> list[float]:
        """Where the open ranks lie among the rows inside, with room for the sketch's error."""
        room = 2.0 / ACCURACY
        if not self.open:
            return [0.5 - room, 0.5 + room]
        least, most = ((k - self.below) / max(self.inside, 1) for k in (self.open[0], self.open[-1]))
        return [max(least - room, 0.0), min(most + room, 1.0)]


def _sketched(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Sets the ends of each search to values just around its open ranks, by one mergeable sketch each."""
    measures = []
    for s in searches:
        inside = F.when(s.between(), s.value)
        measures.append(
            F.struct(
                F.count(inside).alias("n"),
                F.bool_or(F.col(s.column).isNull()).alias("has_gap"),
                F.approx_percentile(inside, s.shares(), ACCURACY).alias("ends"),
            ).alias(s.column)
        )
    row = df.agg(*measures).first()
    for s in searches:
        n, has_gap, ends = row[s.column]
        if math.isinf(s.low) and math.isinf(s.high):
            s.rows, s.inside, s.has_gap = n, n, bool(has_gap)
            s.open = sorted({(n + 1) // 2, (n + 2) // 2}) if n else []
        if ends:
            s.low, s.high = ends


def _confirmed(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Counts exactly what lies below, at and between the ends of each search.

    A rank that falls on an end is found: a value that fills any share of the
    rows costs one row of the result.  A rank outside moves the ends there, so
    a wrong guess of the sketch costs a round, not the result.
    """
    measures = []
    for s in searches:
        low, high = F.lit(s.low), F.lit(s.high)
        measures.append(
            F.struct(
                count_where(s.value < low).alias("before"),
                count_where(s.value == low).alias("at_low"),
                count_where(s.between()).alias("inside"),
                count_where(s.value == high).alias("at_high"),
                F.approx_count_distinct(F.when(s.between(), s.value)).alias("distinct"),
            ).alias(s.column)
        )
    row = df.agg(*measures).first()
    for s in searches:
        before, at_low, inside, at_high, s.distinct = row[s.column]
        upto, left = before + at_low, []
        at_high = 0 if s.low == s.high else at_high
        for k in s.open:
            if before < k <= upto:
                s.found[k] = s.low
            elif upto + inside < k <= upto + inside + at_high:
                s.found[k] = s.high
            else:
                left.append(k)
        if left and left[0] <= before:
            s.low, s.high, s.below, s.inside, s.distinct = -math.inf, s.low, 0, before, before
        elif left and left[-1] > upto + inside:
            s.below, s.low, s.high = upto + inside + at_high, s.high, math.inf
            s.inside = s.distinct = s.rows - s.below
        else:
            s.below, s.inside = upto, inside
        s.open = left


def _ordered(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Orders the few distinct values between the ends, and reads the open ranks off."""
    cells = [
        F.struct(F.lit(s.column).alias("column_name"), F.when(s.between(), s.value).alias("value")) for s in searches
    ]
    counts = df.select(F.inline(F.array(*cells))).filter("value is not null").groupBy("column_name", "value").count()
    upto = Window.partitionBy("column_name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.sum("count").over(upto))
    wanted = F.lit(False)
    for s in searches:
        for k in s.open:
            here = F.lit(k - s.below).between(F.col("upto") - F.col("count") + 1, F.col("upto"))
            wanted = wanted | ((F.col("column_name") == s.column) & here)
    for row in ranked.filter(wanted).collect():
        for s in searches:
            if s.column == row.column_name:
                last = s.below + row.upto
                s.found |= {k: row.value for k in s.open if last - row["count"] < k <= last}
    for s in searches:
        s.open = []


def exact_medians(df: DataFrame, columns: Sequence[str], most_ordered: int = MOST_ORDERED) -> DataFrame:
    """(column_name, median, has_gap) with the exact mean of the middle two values.

    A sketch brackets the middle, exact counts confirm the bracket, and the
    next sketch looks inside, until the bracket holds at most ``most_ordered``
    distinct values (give or take the error of an estimated count); one task
    per column orders these.  Each round is one aggregate over all columns that
    sends one row per task, and shrinks the rows of a bracket some thousandfold,
    so a trillion rows take three.  Tables of no more rows than one task may
    order go there at once.  The rounds run when the plan is built: ``df`` is
    read once for each, so a costly one should have been written.
    """
    searches = [_Search(c, number_of(df, c)) for c in columns]
    _sketched(df, searches)
    for s in searches:
        if s.inside <= most_ordered:
            s.low, s.high = -math.inf, math.inf
            s.distinct = s.inside
    few = [s for s in searches if s.open and s.distinct and s.distinct <= most_ordered]
    rest = [s for s in searches if s.open and s not in few]
    while rest:
        _confirmed(df, rest)
        rest = [s for s in rest if s.open]
        few += [s for s in rest if min(s.inside, s.distinct) <= most_ordered]
        rest = [s for s in rest if s not in few]
        if rest:
            _sketched(df, rest)
    if few:
        _ordered(df, few)
    rows = [(s.column, sum(s.found.values()) / len(s.found) if s.found else None, s.has_gap) for s in searches]
    kept = [r for r in rows if r[1] is not None or r[2]]
    return df.sparkSession.createDataFrame(kept, "column_name string, median double, has_gap boolean")


def approximate_medians(
    df: DataFrame, columns: Sequence[str], accuracy: int = 10_000
) -> DataFrame:
    """(column_name, median, has_gap) by one mergeable sketch per column, in one pass."""
    return (
        _cells(df, columns, number=True)
        .groupBy("column_name")
        .agg(
            F.approx_percentile("value", 0.5, accuracy).alias("median"),
            F.bool_or("gap").alias("has_gap"),
        )
    )


def exact_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, mode): the most frequent value, ties to the smallest."""
    return (
        _value_counts(df, columns, number=False)
        .filter("value is not null")
        .groupBy("column_name")
        .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    )


def _one_decimal(value: float | None) -> str | None:
    """As the audit shows it: halves of the shortest decimal form go up."""
    if value is None:
        return None
    return str(Decimal(repr(value)).quantize(Decimal("0.1"), ROUND_HALF_UP))


def fill_edits(
    df: DataFrame,
    strategies: Mapping[str, str],
    approximate: bool = False,
) -> list[Edit]:
    """Edits per strategy; unknown strategy names are an error."""
    present = {c: s for c, s in strategies.items() if c in df.columns}
    medians = [c for c, s in present.items() if s == "median"]
    modes = [c for c, s in present.items() if s == "mode"]
    if medians:
        find = approximate_medians if approximate else exact_medians
        # A column without a gap gets no fill, so its unreadable texts stay NULL.
        median_of = {r.column_name: r.median for r in find(df, medians).filter("has_gap").collect()}
    if modes:
        # One row per column.
        mode_of = {r.column_name: r["mode"] for r in exact_modes(df, modes).collect()}
    edits = []
    for column, strategy in present.items():
        old = F.col(column)
        counted = old.isNull()
        note = None
        if strategy == "median":
            fill = F.lit(median_of.get(column)).cast("double")
            value = F.coalesce(number_of(df, column), fill)
            note = _one_decimal(median_of.get(column))
        elif strategy == "mode":
            note = mode_of.get(column)
            value = F.coalesce(old, F.lit(note).cast(df.schema[column].dataType))
        elif strategy == "unknown":
            value = F.coalesce(old, F.lit(UNKNOWN))
        elif strategy == "zero":
            value = F.coalesce(old, F.lit(0).cast(df.schema[column].dataType))
        elif strategy == "skip":
            value = old
        else:
            raise ValueError(f"unknown fill strategy {strategy!r} for column {column!r}")
        edits.append(Edit(STEP, column, value, {strategy: counted}, note))
    return edits


def impute(
    df: DataFrame,
    table: str,
    rules: CleaningRules = DEFAULT_RULES,
    approximate: bool = False,
) -> DataFrame:
    """Fill missing values by the table's strategies."""
    return apply_edits(df, fill_edits(df, rules.fill.get(table, {}), approximate))


def impute_columns(df: DataFrame, strategies: Mapping[str, str]) -> DataFrame:
    return apply_edits(df, fill_edits(df, strategies))
