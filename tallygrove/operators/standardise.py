"""Row-wise cleaning: dates, categories, bounds and types. No shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

from tallygrove.functions.numbers import finite, to_number
from tallygrove.functions.text import canonical, parse_date, strip
from tallygrove.operators.edits import Edit, apply_edits
from tallygrove.rules import DEFAULT_RULES, CleaningRules

DATES = "date_normalisation"
CATEGORIES = "categorical_standardisation"
OUTLIERS = "outlier_treatment"
TYPES = "type_casting"


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, StringType)


def number_of(df: DataFrame, column: str) -> Column:
    """A column as double, whether it arrives as text or as a number."""
    if _is_text(df, column):
        return to_number(F.col(column))
    return finite(F.col(column).cast("double"))


def _date_of(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.col(column).cast("date")
    return parse_date(F.col(column).cast("string"))


# -- dates -------------------------------------------------------------------


def date_edits(df: DataFrame, columns: Iterable[str]) -> list[Edit]:
    edits = []
    for column in columns:
        if column not in df.columns:
            continue
        parsed = _date_of(df, column)
        present = F.col(column).isNotNull()
        edits.append(
            Edit(
                DATES,
                column,
                parsed,
                {"failed": present & parsed.isNull(), "parsed": parsed.isNotNull()},
            )
        )
    return edits


def normalise_dates(
    df: DataFrame, table: str, rules: CleaningRules = DEFAULT_RULES
) -> DataFrame:
    """Mixed spellings to dates; unreadable ones become NULL."""
    return apply_edits(df, date_edits(df, rules.date_columns.get(table, ())))


# -- categories --------------------------------------------------------------


def category_edits(df: DataFrame, table: str, rules: CleaningRules) -> list[Edit]:
    edits = []
    for column, mapping in rules.value_maps(table).items():
        if column not in df.columns:
            continue
        original = F.col(column)
        mapped = canonical(original, mapping)
        changed = mapped.isNotNull() & (mapped != original)
        edits.append(Edit(CATEGORIES, column, F.coalesce(mapped, original), {"changed": changed}))
    return edits


def standardise_categories(
    df: DataFrame, table: str, rules: CleaningRules = DEFAULT_RULES
) -> DataFrame:
    """Known spellings to their canonical form; unknown texts stay."""
    return apply_edits(df, category_edits(df, table, rules))


def unmapped_values(
    df: DataFrame, table: str, rules: CleaningRules = DEFAULT_RULES
) -> DataFrame:
    """Per column: number of distinct texts without a canonical form, first five.

    Distinct values are counted after a shuffle on (column, value); the sample
    comes from a rank filter that is cut to five rows per column and map task.
    No set of values is ever collected whole.
    """
    maps = {c: m for c, m in rules.value_maps(table).items() if c in df.columns}
    if not maps:
        return df.sparkSession.createDataFrame(
            [], "column_name string, n_unmapped bigint, sample array<string>"
        )
    cells = []
    for column, mapping in maps.items():
        original = F.col(column)
        text = strip(original)
        unknown = canonical(original, mapping).isNull() & ~text.isin(
            sorted(set(mapping.values()))
        )
        cells.append(
            F.when(unknown, F.struct(F.lit(column).alias("column_name"), text.alias("value")))
        )
    distinct = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .filter("cell is not null")
        .select("cell.*")
        .distinct()
    )
    counts = distinct.groupBy("column_name").agg(F.count("*").alias("n_unmapped"))
    by_value = Window.partitionBy("column_name").orderBy("value")
    sample = (
        distinct.withColumn("__rank", F.row_number().over(by_value))
        .filter("__rank <= 5")
        .groupBy("column_name")
        .agg(F.sort_array(F.collect_list("value")).alias("sample"))
    )
    return counts.join(sample, "column_name")


# -- bounds ------------------------------------------------------------------


def outside_bounds(df: DataFrame, column: str, rules: CleaningRules, sibling: bool = True) -> Column:
    number = number_of(df, column)
    low, high = rules.bounds[column]
    outside = F.lit(False)
    if low is not None:
        outside = outside | (number < low)
    if high is not None:
        outside = outside | (number > high)
    limit = rules.column_bounds.get(column)
    if sibling and limit in df.columns:
        outside = outside | (number > number_of(df, limit))
    return F.coalesce(outside, F.lit(False))


def outlier_edits(df: DataFrame, rules: CleaningRules, sibling: bool = True) -> list[Edit]:
    edits = []
    for column in rules.bounds:
        if column in df.columns:
            outside = outside_bounds(df, column, rules, sibling)
            edits.append(
                Edit(OUTLIERS, column, F.when(~outside, F.col(column)), {"outside": outside})
            )
    return edits


def null_outliers(
    df: DataFrame, rules: CleaningRules = DEFAULT_RULES, sibling: bool = True
) -> DataFrame:
    """Out-of-bounds numbers become NULL; nothing is clamped."""
    return apply_edits(df, outlier_edits(df, rules, sibling))


def null_above_sibling(df: DataFrame, column: str, limit: str) -> DataFrame:
    """NULL where a number exceeds the number in another column of its row."""
    above = F.coalesce(number_of(df, column) > number_of(df, limit), F.lit(False))
    return df.withColumn(column, F.when(~above, F.col(column)))


# -- types -------------------------------------------------------------------


def cast_edits(
    df: DataFrame, rules: CleaningRules, types: dict[str, DataType] | None = None
) -> list[Edit]:
    types = types or {}
    edits = []
    for column in df.columns:
        if column in rules.integer_columns:
            # Through double, so that "34.0" is read; halves round up.
            value = F.floor(number_of(df, column) + 0.5).try_cast("int")
        elif column in rules.float_columns:
            value = number_of(df, column)
            if column in types:
                value = value.try_cast(types[column])
        elif _is_text(df, column):
            value = strip(F.col(column))
            if column in types and not isinstance(types[column], StringType):
                value = value.try_cast(types[column])
        else:
            continue
        edits.append(Edit(TYPES, column, value))
    return edits


def cast_types(
    df: DataFrame,
    rules: CleaningRules = DEFAULT_RULES,
    types: dict[str, DataType] | None = None,
) -> DataFrame:
    """Integer and float columns typed (unreadable -> NULL), texts trimmed."""
    return apply_edits(df, cast_edits(df, rules, types))
