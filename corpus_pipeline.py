"""The corpus pipeline: five stages from raw documents to a mix for training.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.llm import decontaminate, line_dedup, mixing, quality_classifier, simhash_dedup
from tallygrove.llm.shared import staged

#: Column names of the documents; every stage but the last returns its input's columns.
ID, TEXT, SOURCE = "doc_id", "text", "source"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.keep_accepted(docs, labels, ID, TEXT)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go; a document of which nothing is left goes with them.

    ``n_chars`` follows the text.
    """
    cut = line_dedup.line_dedup(docs, ID, TEXT)
    emptied = (F.col("n_removed_lines") > 0) & ~F.col(TEXT).rlike(r"[^\x20\x09-\x0D]")
    left = cut.filter(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_removed_lines") > 0, F.length(TEXT)).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash_dedup.keep_first(docs, ID, TEXT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.keep_clean(docs, benchmark, ID, TEXT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix, with their words, their source's and the words taken."""
    return mixing.mix_documents(docs, ID, TEXT, SOURCE)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("simhash_dedup", near_duplicates),
    ("decontaminate", decontaminated),
    ("mixing", mixed),
]

#: The classifier's scores and the fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
