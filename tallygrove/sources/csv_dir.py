"""Reading a folder of CSV tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrove.rules import MISSING_MARKS

ARRIVAL = ("__file", "__block", "__row")
# Holds the text of a row that has more fields than the header.
RESCUED = "__rescued"
_RECORD, _MORE = "__record", "__more"
_STEM = r"([^/]+)\.csv(/[^/]*)?$"


def csv_table_names(spark: SparkSession, folder: str) -> list[str]:
    """Stems of the ``*.csv`` files (or ``*.csv`` folders of part files) right in the folder."""
    lister = spark.read.format("binaryFile")
    try:
        files = lister.load(f"{folder.rstrip('/')}/*.csv")
    except AnalysisException:
        try:
            lister.load(folder)
        except AnalysisException as error:
            raise FileNotFoundError(f"Input directory not found: {folder}") from error
        return []
    stems = (
        files.select(F.regexp_extract("path", _STEM, 1).alias("stem"))
        .filter("stem <> ''")
        .distinct()
    )
    return sorted(row.stem for row in stems.collect())


def read_csv(
    spark: SparkSession, path: str, multi_line: bool = True, arrival: bool = False, rescue: bool = False
) -> DataFrame:
    """One raw table, every column as text, missing marks as NULL.

    Columns are matched by the header, so a file may leave some out or order
    them in its own way.  Quoted values may hold line breaks, so a file is read
    as a whole by one task; ``multi_line=False`` splits files that are known to
    hold none.

    A row with fewer fields than the header has NULL in the others.  One with
    more is an error, or with ``rescue`` stays, with its whole text in the
    column ``RESCUED``; an empty field behind the last one does not count.
    """
    options = {"header": True, "enforceSchema": False, "multiLine": multi_line, "escape": '"'}
    names = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, _RECORD)])
    # All fields are parsed whatever is asked for: else a row's length is not seen.
    whole = {"columnNameOfCorruptRecord": _RECORD, "columnPruning": False}
    df = spark.read.options(**options, **whole).schema(schema).csv(path)
    columns = {c: F.col(f"`{c}`") for c in names}
    # A task reads its part of a file from the top, so its row numbers follow the file.
    order = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    places = [value.alias(name) for name, value in zip(ARRIVAL, order, strict=True)]
    # Rows of another length come with their text; read with a column more, it tells which are longer.
    fields = ", ".join(f"f{i} string" for i, _ in enumerate(names))
    longer = F.from_csv(F.col(_RECORD), f"{fields}, {_MORE} string", {"escape": '"', "multiLine": "true"})
    # Spark reads the text of a row only beside another column, so a blank part of the first one goes with it.
    text = F.concat(F.substring(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), 1, 0), F.col(_RECORD))
    surplus = F.when(F.col(_RECORD).isNotNull() & longer[_MORE].isNotNull(), text)
    read = df.select(
        *(places if arrival else ()),
        *[F.when(~value.isin(list(MISSING_MARKS)), value).alias(c) for c, value in columns.items()],
        surplus.alias(RESCUED),
    )
    if rescue:
        return read
    text = F.concat(F.lit(f"{path}: more fields than the header has: "), F.col(RESCUED))
    return read.filter(F.when(F.col(RESCUED).isNotNull(), F.raise_error(text)).otherwise(True)).drop(RESCUED)


def load_csv_tables(
    spark: SparkSession, folder: str, multi_line: bool = True, arrival: bool = False, rescue: bool = False
) -> dict[str, DataFrame]:
    """Every ``*.csv`` of a folder as a raw table named after its file.

    ``arrival`` adds the columns of ``ARRIVAL``: file and place in it.
    ``rescue`` adds ``RESCUED`` (see :func:`read_csv`); cleaning counts such
    rows and drops the column.
    """
    names = csv_table_names(spark, folder)
    if not names:
        raise ValueError(f"No CSV files found in: {folder}")
    base = folder.rstrip("/")
    return {name: read_csv(spark, f"{base}/{name}.csv", multi_line, arrival, rescue) for name in names}
