"""Declared types, NOT NULL marks and primary keys as a data check."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField

from tallygrove import model
from tallygrove.functions.numbers import count_where, to_number
from tallygrove.functions.text import parse_date


def _uncastable(field: StructField) -> Column:
    value = F.col(field.name).cast("string")
    if isinstance(field.dataType, StringType):
        return F.lit(False)
    if isinstance(field.dataType, DateType):
        cast = parse_date(value)
    elif isinstance(field.dataType, IntegerType):
        number = to_number(value)
        cast = F.when(number == F.floor(number), number)
    else:
        cast = to_number(value)
    return value.isNotNull() & cast.isNull()


def check_table(df: DataFrame, table: str) -> DataFrame:
    """One row per declared column of a table.

    All column counts come from one aggregate without a shuffle of rows; the
    key check is separate and moves the key column only.
    """
    pk = model.PRIMARY_KEY[table]
    fields = model.clean_schema(table).fields
    present = [f for f in fields if f.name in df.columns]
    measures = [F.count("*").alias("__rows")]
    for f in present:
        measures.append(count_where(F.col(f.name).isNull()).alias(f"{f.name}__null"))
        measures.append(count_where(_uncastable(f)).alias(f"{f.name}__bad"))
    counts = df.agg(*measures)
    if pk in df.columns:
        keys = df.filter(F.col(pk).isNotNull()).groupBy(pk).agg(F.count("*").alias("n"))
        extra = keys.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"))
        counts = counts.withColumn("__extra", extra.scalar())
    rows = []
    for f in fields:
        here = f.name in df.columns
        nulls = F.col(f"{f.name}__null") if here else F.lit(None).cast("bigint")
        rows.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("declared_type"),
                F.lit(int(f.nullable)).alias("is_nullable"),
                F.lit(int(here)).alias("is_present"),
                F.col("__rows").alias("n_rows"),
                nulls.alias("n_null"),
                (F.lit(0).cast("bigint") if f.nullable else nulls).alias("n_null_violations"),
                (F.col(f"{f.name}__bad") if here else F.lit(None).cast("bigint")).alias("n_uncastable"),
                (F.col("__extra") if here and f.name == pk else F.lit(0).cast("bigint")).alias(
                    "n_repeated_keys"
                ),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def schema_check(tables: Mapping[str, DataFrame]) -> DataFrame:
    known = [check_table(df, name) for name, df in tables.items() if name in model.CLEAN_COLUMNS]
    return reduce(DataFrame.unionByName, known)


def declared_ddl(table: str) -> str:
    """The declared columns as Spark DDL text."""
    return model.clean_schema(table).toDDL()
