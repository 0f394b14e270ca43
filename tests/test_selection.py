"""Medians, ranks and reference keys against brute force, where many rows crowd."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrove.operators import impute, references
from tallygrove.operators.ranks import with_dense_rank
from tallygrove.operators.staging import written_stage
from tests.conftest import plan_of


@pytest.mark.parametrize("most", [100_000, 5])
@pytest.mark.parametrize("seed", range(4))
def test_medians_random(spark, seed, most):
    rng = random.Random(seed)
    n = rng.choice([1, 2, 999, 3000])
    pick = lambda: rng.choice([None, 1.0, 2.5, rng.gauss(0, 1e3), rng.gauss(5, 1e-6)])
    rows = [(pick(), pick(), 7.0 if rng.random() < 0.6 else rng.random()) for _ in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {r.column_name: r for r in impute.exact_medians(df, list("abc"), most).collect()}
    for i, c in enumerate("abc"):
        values = [r[i] for r in rows if r[i] is not None]
        if values:
            assert got[c]["median"] == statistics.median(values)
        assert c not in got or got[c].has_gap == any(r[i] is None for r in rows)


def test_a_million_values_close_together(spark, monkeypatch):
    """No task orders more distinct values than it may, though all lie within a millionth."""
    ordered = []
    plain = impute._ordered
    monkeypatch.setattr(impute, "_ordered", lambda df, found: (ordered.extend((s.inside, s.distinct) for s in found), plain(df, found)))
    df = spark.range(1_000_001, numPartitions=8).select((F.lit(1000.0) + F.col("id") * 1e-9).alias("a"))
    got = impute.exact_medians(df, ["a"], 20_000).first()
    assert got["median"] == 1000.0 + 500_000 * 1e-9
    assert all(min(n) <= 20_000 for n in ordered)


def test_medians_where_the_sketch_is_wrong(spark, monkeypatch):
    """Exact counts find out, and the search goes on beside the bracket."""
    df = spark.range(1001).select(F.col("id").cast("double").alias("a"))
    plain, wrong = impute._sketched, [(900.0, 950.0), (10.0, 20.0)]

    def misled(rows, searches):
        plain(rows, searches)
        if wrong:
            for s in searches:
                s.low, s.high = wrong.pop()

    monkeypatch.setattr(impute, "_sketched", misled)
    assert impute.exact_medians(df, ["a"], 3).first()["median"] == 500.0


def test_no_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    got = {r.column_name: tuple(r)[1:] for r in impute.exact_medians(df, ["a", "b"]).collect()}
    assert got == {"a": (None, True), "b": (1.0, True)}
    assert impute.exact_medians(df.limit(0), ["a"]).count() == 0


def ranked(rows):
    out = []
    for g in {r[1] for r in rows}:
        values = sorted({r[2] for r in rows if r[1] == g}, key=lambda v: (v is not None, v != v if v is not None else False, v))
        out += [(r[0], g, values.index(r[2]) + 1) for r in rows if r[1] == g]
    return sorted(out, key=str)


def test_dense_rank_of_one_group_with_all_rows(spark):
    rng = np.random.default_rng(3)
    values = [None, 0.0, -0.5, 1e300, -1e300, float("inf"), -float("inf"), *map(float, rng.normal(0, 50, 300).round(1))]
    rows = [(i, "hot" if i % 50 else None, values[int(rng.integers(0, len(values)))]) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    out = with_dense_rank(df, "g", "v", "place")
    assert sorted(((r.id, r.g, r.place) for r in out.collect()), key=str) == ranked(rows)
    assert out.columns == ["id", "g", "v", "place"]
    # Rows meet by group and slice, never by group alone.
    assert "hashpartitioning(g" in plan_of(out) and "__slice" in plan_of(out)
    assert with_dense_rank(df.limit(0), "g", "v", "place").count() == 0


def test_bitmaps_hold_exactly_the_numbered_keys(spark, tmp_path):
    """Leading zeros, other prefixes and numbers near a set bit are no keys."""
    rng = random.Random(2)
    keys = {f"BEN-{rng.randint(0, 70_000)}" for _ in range(3000)} | {"BEN-0", "X1", "9", "BEN-999999999999999999"}
    used = [f"BEN-{rng.randint(0, 70_000)}" for _ in range(3000)] + ["BEN-00", "BEN-007", "ben-1", "X01", "X1", "9", "", "BEN-", "a\n1", None, "1" * 30]
    parents = spark.createDataFrame([(k,) for k in keys], "id string")
    child = spark.createDataFrame(list(enumerate(used)), "n long, ref string")
    stage = written_stage(str(tmp_path))
    bad = references.orphan_keys(child, "ref", parents, "id", stage, "x")
    assert {r.orphan_key for r in bad.collect()} == {u for u in used if u is not None} - keys
    # What no bitmap vouches for is broken: nothing is compared with the parents again.
    assert "LeftAnti" not in plan_of(bad)
    out = references.check_reference(child, "ref", parents, "id", "n", stage)
    assert {(r.n, r.ref) for r in out.collect()} == {(n, u if u in keys else None) for n, u in enumerate(used)}


def test_nothing_is_shuffled_where_nothing_is_broken(spark, tmp_path):
    parents = spark.range(0, 300_000).select(F.concat(F.lit("B-"), "id").alias("id"))
    child = spark.range(0, 50_000).select("id", F.concat(F.lit("B-"), F.col("id") % 9000).alias("ref"))
    out = references.check_reference(child.withColumnRenamed("id", "n"), "ref", parents, "id", "n", written_stage(str(tmp_path)))
    assert "Exchange hashpartitioning" not in plan_of(out)
    assert out.filter("ref is null").count() == 0
    used = references.unknown_keys(
        child.select(F.col("ref").alias("orphan_key")), written_stage(str(tmp_path))(references.key_bitmaps(parents, "id"), "b")
    )
    assert "Exchange hashpartitioning" not in plan_of(used)


def test_keys_without_numbers_are_compared_as_texts(spark, tmp_path):
    parents = spark.createDataFrame([("a",), ("b1",)], "id string")
    child = spark.createDataFrame([(1, "a"), (2, "b1"), (3, "c"), (4, None)], "n long, ref string")
    stage = written_stage(str(tmp_path))
    assert [r.orphan_key for r in references.orphan_keys(child, "ref", parents, "id", stage, "x").collect()] == ["c"]
    out = references.check_reference(child, "ref", parents, "id", "n", stage)
    assert {(r.n, r.ref) for r in out.collect()} == {(1, "a"), (2, "b1"), (3, None), (4, None)}
