"""Registered queries of this subpackage: the thin contract over each operator."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.llm import (
    bpe,
    decontaminate,
    html_extract,
    line_dedup,
    mixing,
    passage_dedup,
    phrases,
    pii,
    quality_classifier,
    quality_rules,
    secret_scan,
    simhash_dedup,
    url_filter,
    vector_codes,
)
from tallygrove.llm.oracle import ORACLE
from tallygrove.llm.shared import joined_spans, staged

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return line_dedup.line_dedup(docs.select("doc_id", "text"))


@query
def op1_passage_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return passage_dedup.passage_dedup(docs.select("doc_id", "text"))


def _span_digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans."""

    def base(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint")

    return found.select(
        F.col("id").alias("doc_id"),
        *(base(k).alias(f"n_{k}") for k in kinds),
        F.sha2(joined_spans(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


@query
def op2_secret_scan(spark, sf_dir):
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))
    return _span_digest(found, ("assign", "access", "hex"))


@query
def op3_mixing(spark, sf_dir):
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op4_html_extract(spark, sf_dir):
    texts = html_extract.extract_pages(_table(spark, sf_dir, "pages"))
    return texts.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op5_quality_classifier(spark, sf_dir):
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = quality_classifier.classify(docs, labels)
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score", "predicted")


@query
def op6_simhash_dedup(spark, sf_dir):
    return simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op7_pii(spark, sf_dir):
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    return _span_digest(found, ("email", "ip", "card", "phone"))


@query
def op8_url_filter(spark, sf_dir):
    judged = url_filter.judge(_table(spark, sf_dir, "pages"))
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "score")


@query
def op9_quality_rules(spark, sf_dir):
    entries = quality_rules.ledger(_table(spark, sf_dir, "documents"))
    base, standard = (quality_rules.fails(p) for p in (quality_rules.BASE, quality_rules.STANDARD))
    return entries.withColumns({"base_failed": base, "kept": ~standard})


@query
def op9_policies(spark, sf_dir):
    return quality_rules.apply_policies(quality_rules.ledger(_table(spark, sf_dir, "documents")))


@query
def op9_ablations(spark, sf_dir):
    return quality_rules.ablations(staged(quality_rules.ledger(_table(spark, sf_dir, "documents")), "ledger"))


@query
def op10_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query
def op11_phrases(spark, sf_dir):
    return phrases.phrases(_table(spark, sf_dir, "documents"))


@query
def op12_vector_codes(spark, sf_dir):
    coded, books = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.select(
        F.col("id").alias("vec_id"), vector_codes.hex_codes(F.col("code")).alias("code"),
        "error", "label_error", F.lit(digest).alias("codebooks_sha256"),
    )


@query
def op13_bpe(spark, sf_dir):
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents")
    coded = bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        F.col("id").alias("doc_id"), "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
