"""A third of all rows under one key: joins split it, aggregates combine it early."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tallygrove.operators import dedup, joins, references
from tallygrove.plans import blocks, kpis
from tests.conftest import plan_of

ROWS = 240_000


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.fixture
def shuffled(spark):
    """Cluster-like conditions in miniature: nothing is small enough to broadcast."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
        spark__sql__files__maxPartitionBytes="128KB",
    ):
        yield


def hot_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    spark.range(0, ROWS, 1, 24).select(
        F.format_string("%08d", "id").alias("row_id"), key.alias("key"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_broken_reference_is_split(spark, tmp_path, shuffled):
    rows = hot_rows(spark, tmp_path)
    parents = rows.select(F.col("key").alias("id")).filter("id <> 'hot'").distinct()
    out = references.check_reference(rows, "key", parents, "id", "row_id")
    assert out.count() == ROWS
    assert out.filter("key is null").count() == ROWS // 3
    assert "__copy" in plan_of(out)


def test_null_references_are_spread(spark, tmp_path, shuffled):
    rows = hot_rows(spark, tmp_path).withColumn("key", F.when(F.col("key") != "hot", F.col("key")))
    spread = rows.select(references.spread_key("key", "row_id").alias("k")).filter("k like '\0%'")
    assert spread.groupBy("k").count().count() == 256
    out = references.check_reference(rows, "key", rows.select("key"), "key", "row_id")
    assert out.filter("key is null").count() == ROWS // 3


def test_hot_repeated_key_is_split(spark, tmp_path, shuffled):
    out = dedup.key_repeats(hot_rows(spark, tmp_path), ["key"], "row_id")
    assert len(out.collect()) == ROWS // 3 - 1
    assert "__copy" in plan_of(out)


def test_hot_key_meets_its_copies_in_many_slots(spark, tmp_path, shuffled):
    rows = hot_rows(spark, tmp_path)
    lookup = rows.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("n")).filter("n > 1")
    out = joins.lookup_join(rows, joins.Side(lookup, False), [F.col("key") == F.col("k")], "row_id", "inner")
    sizes = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    assert sum(r.n for r in sizes) == ROWS // 3
    # Eight shuffle partitions: the hot key is in all of them, none has most of it.
    assert len(sizes) >= 6 and max(r.n for r in sizes) < ROWS // 3 // 2


def test_hot_fact_key_is_split_in_a_star_join(spark, tmp_path, shuffled, monkeypatch):
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 10)
    rows = hot_rows(spark, tmp_path)
    facts = rows.select(F.col("row_id").alias("delivery_id"), F.col("key").alias("beneficiary_id"), "payload")
    people = rows.select(F.col("key").alias("beneficiary_id")).distinct().withColumn("gender", F.lit("x"))
    out = joins.star_join({"service_delivery": facts, "beneficiaries": people}, "service_delivery")
    assert len(out.collect()) == ROWS
    # The dimension was just aggregated by its key, and the hot key is split all the same.
    assert "skew=true" in plan_of(out)


def test_hot_person_in_the_reach_report(spark, sample):
    tables = dict(sample.all())
    busy = tables["beneficiaries"].agg(F.min("beneficiary_id")).first()[0]
    extra = spark.range(50_000).select(
        (F.col("id") + 10**9).alias("delivery_id"), F.lit(busy).alias("beneficiary_id"),
        (F.col("id") % 150).alias("intervention_id"), F.lit(None).cast("date").alias("delivery_date"),
    )
    before = {(r.dimension, r.dimension_value): r for r in kpis.demographic_reach(tables).collect()}
    tables["service_delivery"] = tables["service_delivery"].unionByName(extra)
    after = {(r.dimension, r.dimension_value): r for r in kpis.demographic_reach(tables).collect()}
    assert before.keys() == after.keys()
    assert sum(r.total_registered for r in before.values()) == sum(r.total_registered for r in after.values())


def test_first_and_last_test_combine_on_the_map_side(sample):
    plan = plan_of(blocks.matched_pairs(sample["assessments"]))
    assert plan.index("Exchange") < plan.index("partial_min")
