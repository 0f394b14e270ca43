"""Writing table sets."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

PARTITION_COLUMN = "fiscal_year"
AUDIT_NAME = "cleaning_audit_report"
MANIFEST = "manifest"


def write_csv_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Each table as ``<name>.csv``: a folder of part files with a header each."""
    # Blanks around a value are data; the writer would trim them by default.
    options = {
        "header": True,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    for name, df in tables.items():
        df.write.mode("overwrite").options(**options).csv(f"{folder.rstrip('/')}/{name}.csv")


def _writer(df: DataFrame) -> DataFrameWriter:
    """An overwriting writer, partitioned by fiscal year where there is one.

    Without care every task would write a small file for every year.  The
    rebalance hint brings the rows of a year together, and adaptive execution
    splits a year that holds a large share of the table over many tasks.
    """
    if PARTITION_COLUMN not in df.columns:
        return df.write.mode("overwrite")
    balanced = df.hint("rebalance", PARTITION_COLUMN)
    return balanced.write.mode("overwrite").partitionBy(PARTITION_COLUMN)


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Each table as Parquet, in place; those with a fiscal year are partitioned by it.

    A failure leaves the tables before it new and the others old; see
    ``publish_tables`` for replacing a set as a whole.
    """
    for name, df in tables.items():
        _writer(df).parquet(f"{folder.rstrip('/')}/{name}")


def publish_tables(tables: Mapping[str, DataFrame], folder: str) -> int:
    """Replace the whole set of tables at once, or not at all; returns its version.

    Every table goes to a new folder first.  Only when all are there does one
    row of the manifest name them: it is written as one file, so readers see
    all new tables or all old ones.  A failure before leaves the old set in
    place.  Old versions are kept: whoever reads them is not disturbed.  Of two
    runs that publish at the same time, the one with the greater token counts.
    """
    base, token = folder.rstrip("/"), uuid.uuid4().hex
    paths = {name: f"{base}/{name}/{token}" for name in tables}
    for name, df in tables.items():
        _writer(df).parquet(paths[name])
    spark = next(iter(tables.values())).sparkSession
    latest = _latest(spark, folder)
    version = latest.version + 1 if latest else 1
    schema = "version bigint, token string, paths map<string,string>"
    row = spark.createDataFrame([(version, token, paths)], schema)
    row.coalesce(1).write.mode("append").parquet(f"{base}/{MANIFEST}")
    return version


def _latest(spark: SparkSession, folder: str):
    try:
        manifest = spark.read.parquet(f"{folder.rstrip('/')}/{MANIFEST}")
    except AnalysisException:
        return None
    return manifest.orderBy(F.col("version").desc(), F.col("token").desc()).first()


def published_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the last set that was published whole."""
    latest = _latest(spark, folder)
    if latest is None:
        raise FileNotFoundError(f"No tables published in: {folder}")
    return {name: spark.read.parquet(path) for name, path in sorted(latest.paths.items())}


def save_tables(tables: Mapping[str, DataFrame], database: str) -> None:
    """Each table as a managed table of ``database``, replacing what is there."""
    for name, df in tables.items():
        _writer(df).saveAsTable(f"{database}.{name}")


def write_audit(audit: DataFrame, folder: str) -> None:
    """The audit rows as CSV, in run order."""
    # The audit has one row per table and step, so the order costs nothing.
    write_csv_tables({AUDIT_NAME: audit}, folder)
