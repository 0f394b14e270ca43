"""What is too large for the driver is never broadcast, whatever Spark makes of the files' sizes."""

import pytest
from pyspark.sql import functions as F

from tallygrove.llm import phrases
from tallygrove.llm.shared import look_up, row_key, staged, without
from tests.conftest import plan_of

LIMIT = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture(params=["256k", "1g"])
def threshold(spark, request):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, request.param)
    yield request.param
    spark.conf.set(LIMIT, before)


def joined_without_broadcast(df):
    """The rows; both the first plan and the one that ran hold no broadcast."""
    assert "Broadcast" not in plan_of(df)
    rows = df.collect()
    assert "Broadcast" not in plan_of(df)
    return rows


def test_wide_keys_are_shuffled(spark, threshold):
    keys = staged(spark.range(150_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id"), "wide")
    rows = spark.range(0, 300_000, 3_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.col("id").alias("n"))
    for how, wanted in (("left_semi", range(0, 150_000, 3_000)), ("left", range(0, 300_000, 3_000))):
        got = joined_without_broadcast(look_up(rows, keys, ["k"], "n", how).select("n"))
        assert sorted(r.n for r in got) == list(wanted)


def test_copies_of_many_narrow_keys_are_shuffled(spark, threshold):
    keys = staged(spark.range(300_000).select(F.col("id").alias("k")), "narrow")
    rows = spark.range(0, 600_000, 3_000).select(F.col("id").alias("k"))
    got = joined_without_broadcast(look_up(rows, keys, ["k"], "k", "left_semi"))
    assert sorted(r.k for r in got) == list(range(0, 300_000, 3_000))


def test_many_dropped_documents_are_shuffled(spark, threshold):
    docs = spark.range(250_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    keys = docs.filter("doc_id >= 10").select(row_key(docs, "doc_id", "text").alias("key"))
    got = joined_without_broadcast(without(docs, keys, "doc_id", "text"))
    assert sorted(r.doc_id for r in got) == list(range(10))


def test_few_keys_are_broadcast(spark):
    keys = staged(spark.range(100).select(F.col("id").alias("k")), "few")
    assert "BroadcastHashJoin" in plan_of(look_up(spark.range(1000).select(F.col("id").alias("k")), keys, ["k"], "k", "left_semi"))


def test_growing_keys_are_shuffled_at_every_size(spark, threshold):
    keys = staged(spark.range(100).select(F.col("id").alias("k")), "growing")
    rows = spark.range(0, 200, 10).select(F.col("id").alias("k"))
    got = joined_without_broadcast(look_up(rows, keys, ["k"], "k", "left_semi", grows=True))
    assert sorted(r.k for r in got) == list(range(0, 100, 10))


def _documents(spark):
    return spark.range(200).select(F.lit("en").alias("lang"), F.expr("concat_ws(' ', 'a', id, id + 1, id % 7, id % 5)").alias("text"))


def test_pair_hashes_do_not_reach_the_driver_as_rows(spark, monkeypatch):
    docs, longest = _documents(spark), []

    def collect(self, whole=type(docs).collect):
        longest.append(len(rows := whole(self)))
        return rows

    monkeypatch.setattr(type(docs), "collect", collect)
    grams, _ = phrases.frequent_grams(docs, least=1)
    assert max(longest, default=0) < 50
    monkeypatch.undo()
    assert grams.filter("length = 2").count() > 200


def test_grams_are_never_broadcast(spark, threshold):
    out = phrases.phrases(_documents(spark), least=2)
    assert plan_of(out).count("BroadcastHashJoin") <= 1  # the words of each language
    assert out.collect()
    assert plan_of(out).split("== Initial Plan ==")[0].count("BroadcastHashJoin") <= 1
