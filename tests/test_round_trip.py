"""Sets published whole, rows longer than their header, repeats, and a log with memory."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallygrove import model
from tallygrove.operators import quality
from tallygrove.plans.clean import clean
from tallygrove.sources import csv_dir, sinks
from tests.conftest import plan_of

DAY = dt.date(2025, 1, 1)


def ids(df, column):
    return sorted(r[column] for r in df.collect())


def test_a_failing_table_leaves_the_old_set(spark, tmp_path):
    folder = str(tmp_path)
    table = lambda *x: spark.createDataFrame([(v,) for v in x], "a long")
    with pytest.raises(FileNotFoundError):
        sinks.published_tables(spark, folder)
    assert sinks.publish_tables({"one": table(1), "two": table(2), "three": table(3)}, folder) == 1
    broken = table(9).select(F.when(F.col("a") == 9, F.raise_error(F.lit("no"))).cast("long").alias("a"))
    with pytest.raises(Exception, match="no"):
        sinks.publish_tables({"one": table(7), "two": table(8), "three": broken}, folder)
    old = sinks.published_tables(spark, folder)
    assert {n: ids(df, "a") for n, df in old.items()} == {"one": [1], "two": [2], "three": [3]}
    assert sinks.publish_tables({"one": table(4), "two": table(5)}, folder) == 2
    new = sinks.published_tables(spark, folder)
    assert {n: ids(df, "a") for n, df in new.items()} == {"one": [4], "two": [5]}
    # Whoever holds the old set can go on reading it.
    assert ids(old["three"], "a") == [3]


@pytest.mark.parametrize("multi_line", [True, False])
def test_rows_that_do_not_fit_the_header(spark, tmp_path, multi_line):
    lines = ["donor_id,donor_name,country", "D1,Ann,IN", "D2,Bob", 'D3,"C, D",IN,"more, here"', "D4,E,IN,", "D5,F,NA"]
    (tmp_path / "donors.csv").write_text("\n".join(lines) + "\n")
    with pytest.raises(Exception, match="more fields than the header"):
        csv_dir.load_csv_tables(spark, str(tmp_path), multi_line)["donors"].count()
    raw = csv_dir.load_csv_tables(spark, str(tmp_path), multi_line, rescue=True)
    rows = {r.donor_id: r for r in raw["donors"].collect()}
    assert len(rows) == raw["donors"].count() == 5
    assert [rows["D2"].donor_name, rows["D2"].country] == ["Bob", None] and rows["D5"].country is None
    assert {k for k, r in rows.items() if r[csv_dir.RESCUED]} == {"D3"}
    assert rows["D3"][csv_dir.RESCUED] == lines[3] and rows["D3"].donor_name == "C, D"
    assert raw["donors"].select(csv_dir.RESCUED).filter(f"{csv_dir.RESCUED} is not null").count() == 1
    for stage in (None, str(tmp_path / "stage")):
        result = clean(raw, stage_dir=stage)
        assert result.tables["donors"].columns == ["donor_id", "donor_name", "country"]
        assert result.audit.filter("step_no = 1").first().details == "1 rows had more fields than the header"


def people(spark, rows):
    return spark.createDataFrame(rows, "beneficiary_id string, full_name string, phone string, region_id string")


def test_exact_repeats_are_issues(spark):
    """One row for each that cleaning drops, also where the keys are equal or NULL."""
    rows = [("B-1", "Ann", "1", "R"), ("B-1", "ann ", "1", "R"), ("B-2", "Ann", "1", "R"), ("B-3", "Eve", None, None)]
    rows += [("B-4", "Odd", "2", None)] * 4 + [(None, "Odd", "2", None)] * 2 + [("B-5-DUP", "Ann", "1", "R")]
    tables = {"beneficiaries": people(spark, rows)}
    found = quality.duplicate_issues(tables["beneficiaries"], "beneficiaries").collect()
    told = sorted((str(r.record_id), r.description) for r in found)
    assert told[:2] == [("B-1", "Repeats 'B-1'"), ("B-2", "Repeats 'B-1'")]
    dropped = clean(tables).audit.filter("step_no = 1").first().rows_affected
    assert len(found) == dropped == len(rows) - 3
    log = quality.issue_log(tables, DAY).filter("issue_type = 'duplicate_entry'")
    assert log.count() == log.select("log_id").distinct().count() == dropped


def test_many_equal_rows_are_spelt_out_in_parts(spark, monkeypatch):
    from tallygrove.operators import dedup

    monkeypatch.setattr(dedup, "_COPIES", 7)
    table = spark.range(100).select(F.lit("B").alias("beneficiary_id"), F.lit("N").alias("full_name"))
    assert dedup.key_repeats(table, ("full_name",), "beneficiary_id").count() == 99
    each = dedup.spread(spark.createDataFrame([("a", 1), ("b", 7), ("c", 15)], "k string, n long"), "n", "copy")
    assert sorted((r.k, r.copy) for r in each.collect()) == [(k, i) for k, n in (("a", 1), ("b", 7), ("c", 15)) for i in range(1, n + 1)]


def test_log_remembers(spark):
    one = {"beneficiaries": people(spark, [("B-1", "Ann", None, "R"), ("B-2", "Bob", None, "R")])}
    two = {"beneficiaries": people(spark, [("B-1", "Ann", "5", "R"), ("B-2", "Bob", None, "R"), ("B-3", "Eve", None, "R")])}
    first = quality.issue_log(one, dt.date(2025, 1, 1))
    merged = quality.merge_log(first, quality.issue_log(two, dt.date(2025, 1, 8)))
    state = lambda log: {r.record_id: (r.resolved, r.detected_date.day) for r in log.collect()}
    assert state(merged) == {"B-1": (1, 1), "B-2": (0, 1), "B-3": (0, 8)}
    again = quality.merge_log(merged, quality.issue_log(two, dt.date(2025, 1, 15)))
    assert state(again) == state(merged) and again.dtypes == first.dtypes
    back = quality.merge_log(again, quality.issue_log(one, dt.date(2025, 1, 22)))
    assert state(back) == {"B-1": (0, 22), "B-2": (0, 1), "B-3": (1, 8)}
    nothing = quality.merge_log(first.limit(0), first.limit(0))
    assert nothing.count() == 0


def test_ids_are_compared_as_bytes(spark):
    """Those of another form, and none, stay as they are."""
    from tests.test_skew import settings

    form = "log_id string, description string, resolved int"
    ours = "DQL-" + "0f" * 32
    old = spark.createDataFrame([(ours, "a", 0), ("DQL-1", "b", 0), ("by hand", "c", 1), (None, "d", 0)], form)
    new = spark.createDataFrame([(ours, "a2", 0), ("by hand", "c2", 0), (ours.upper(), "e", 0), (None, "f", 0)], form)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        merged = quality.merge_log(old, new)
        assert "hashpartitioning(__old_hash" in plan_of(merged)
        want = [(ours, "a", 0), ("DQL-1", "b", 1), ("by hand", "c2", 0), (None, "d", 1), (ours.upper(), "e", 0), (None, "f", 0)]
        assert sorted(map(repr, map(tuple, merged.collect()))) == sorted(map(repr, want))


def test_rows_are_shuffled_once_for_repeated_keys(spark):
    from tallygrove.operators import dedup
    from tests.test_skew import settings

    table = spark.range(100).select(F.col("id").alias("beneficiary_id"), (F.col("id") % 60).cast("string").alias("full_name"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        repeats = dedup.key_repeats(table, ("full_name",), "beneficiary_id")
        # Groups, rows and the groups' copies.
        assert plan_of(repeats).count("Exchange hashpartitioning") == 3
        assert sorted(map(tuple, repeats.collect())) == [(i, i - 60) for i in range(60, 100)]


def test_audit_of_all_twelve_tables(spark, tmp_path):
    """Counted while the tables are written, and by an aggregate of the lazy plan: the same."""
    from checks.fixtures import raw_sample
    from tests.conftest import SMALL

    tables = {n: df.limit(400) for n, df in raw_sample(spark, SMALL).all().items()}
    fixed = {}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / "in" / name))
        fixed[name] = spark.read.parquet(str(tmp_path / "in" / name))
    staged, lazy = clean(fixed, stage_dir=str(tmp_path / "out")), clean(fixed)
    rows = sorted(map(tuple, staged.audit.collect()))
    assert rows == sorted(map(tuple, lazy.audit.collect()))
    assert {r[0] for r in rows} == set(model.CLEANING_ORDER)
    for name in model.CLEANING_ORDER:
        last = max((r for r in rows if r[0] == name), key=lambda r: r[1])
        assert staged.tables[name].count() == last[4]
