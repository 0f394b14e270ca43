"""Fiscal years (April to March) and quarterly reporting periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fiscal_year(day: Column) -> Column:
    """``2024-02-01`` -> ``FY2023-24``."""
    start = F.year(day) - F.when(F.month(day) < 4, 1).otherwise(0)
    ends = F.lpad(((start + 1) % 100).cast("string"), 2, "0")
    return F.concat(F.lit("FY"), start.cast("string"), F.lit("-"), ends)


def fiscal_quarter(day: Column) -> Column:
    """April to June is quarter 1."""
    return F.quarter(F.add_months(day, -3))


def reporting_period(day: Column) -> Column:
    """``2023-08-10`` -> ``Q2-FY2023-24``."""
    return F.concat(
        F.lit("Q"), fiscal_quarter(day).cast("string"), F.lit("-"), fiscal_year(day)
    )


def period_quarter(period: Column) -> Column:
    """Quarter number of a period label."""
    return F.substring(period, 2, 1).try_cast("int")


def period_fiscal_year(period: Column) -> Column:
    """Fiscal year of a period label."""
    return F.substr(period, F.lit(4))


def quarter_calendar(spark: SparkSession, first_start: int = 2021, last_start: int = 2024) -> DataFrame:
    """Every reporting period from one fiscal year to another."""
    first, last = dt.date(first_start, 4, 1), dt.date(last_start + 1, 1, 1)
    starts = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 3 months")))
    return spark.range(1).select(starts.alias("quarter_start")).select(
        "quarter_start",
        reporting_period(F.col("quarter_start")).alias("reporting_period"),
        fiscal_year(F.col("quarter_start")).alias("fiscal_year"),
        fiscal_quarter(F.col("quarter_start")).alias("quarter_num"),
    )
