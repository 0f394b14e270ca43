"""Totals by one dimension at a time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_dimension_totals(
    df: DataFrame, dimensions: Mapping[str, str], sums: Sequence[str]
) -> DataFrame:
    """Sum columns by each dimension apart, stacked: (dimension, raw_value, sums).

    ``dimensions`` maps a shown name to its column.  The rows are first summed
    per combination of values, so the copying that grouping sets do happens
    on that smaller set, and the input is read once for all dimensions.  A
    NULL value is a group of its own.
    """
    columns = list(dimensions.values())
    combined = df.groupBy(*columns).agg(*[F.sum(s).alias(s) for s in sums])
    sets = [[F.col(c)] for c in columns]
    grouped = combined.groupingSets(sets, *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("__gid"), *[F.sum(s).alias(s) for s in sums]
    )
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    width = len(columns)
    for i, (dimension, column) in enumerate(dimensions.items()):
        # In the grouping id a 0 bit marks the column that is grouped by.
        here = F.col("__gid") == (2**width - 1) - 2 ** (width - 1 - i)
        name = F.when(here, dimension).otherwise(name)
        value = F.when(here, F.col(column).cast("string")).otherwise(value)
    return grouped.select(name.alias("dimension"), value.alias("raw_value"), *sums)
