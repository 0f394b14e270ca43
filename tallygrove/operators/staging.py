"""Writing intermediate tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Stage = Callable[[DataFrame, str], DataFrame]


def as_is(df: DataFrame, name: str) -> DataFrame:
    """No staging: the plan stays lazy."""
    return df


def written_stage(folder: str) -> Stage:
    """Write an intermediate table below ``folder`` and go on from the files.

    This cuts the lineage (a lost executor re-reads files instead of repeating
    the run), lets several uses share one computation, and makes it cheap to
    measure what is about to be broadcast.  Executors must all reach the folder.
    """

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return stage
