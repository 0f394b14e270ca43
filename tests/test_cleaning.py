"""Cleaning steps on hand-written rows."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallygrove import model
from tallygrove.functions.text import parse_date
from tallygrove.operators import dedup, impute, quality, references, standardise
from tallygrove.operators.schema_check import check_table
from tallygrove.plans.clean import clean, clean_table
from tests.conftest import SMALL, plan_of


def values(df, column):
    return [row[column] for row in df.collect()]


DATES = {
    "2023-05-06": dt.date(2023, 5, 6),
    "2023/05/06": dt.date(2023, 5, 6),
    "05/06/2023": dt.date(2023, 6, 5),
    "5/6/2023": dt.date(2023, 6, 5),
    "05-06-2023": dt.date(2023, 6, 5),
    "05.06.2023": dt.date(2023, 6, 5),
    "05-25-2023": dt.date(2023, 5, 25),
    "05/25/2023": dt.date(2023, 5, 25),
    "05-Jan-23": dt.date(2023, 1, 5),
    "05-JAN-2023": dt.date(2023, 1, 5),
    "05-Jan-75": dt.date(1975, 1, 5),
    "05-Jan-68": dt.date(2068, 1, 5),
    " 2023-05-06 ": dt.date(2023, 5, 6),
    "2023-05-06 10:11:12": dt.date(2023, 5, 6),
    "2023-05-06T10:11:12": dt.date(2023, 5, 6),
    "5 June 2023": dt.date(2023, 6, 5),
    "5th of June 2023": None,
    "5th June 2023": dt.date(2023, 6, 5),
    "June 5, 2023": dt.date(2023, 6, 5),
    "Sept. 5th, 2023": dt.date(2023, 9, 5),
    "05/06/23": dt.date(2023, 6, 5),
    "05/25/99": dt.date(1999, 5, 25),
    "20230605": dt.date(2023, 6, 5),
    "20231305": None,
    "2023.06.05": dt.date(2023, 6, 5),
    "5/6/2023 10:00": dt.date(2023, 6, 5),
    "5/6/2023 9:05 PM": dt.date(2023, 6, 5),
    "2023-06-05T10:00:00Z": dt.date(2023, 6, 5),
    "2023-06-05 10:00:00.5+05:30": dt.date(2023, 6, 5),
    "June 31, 2023": None,
    "Juneau 5, 2023": None,
    "31/02/2023": None,
    "2023-13-01": None,
    "05/06-2023": None,
    "05-Foo-23": None,
    "not a date": None,
    "": None,
    None: None,
}


def test_dates(spark):
    df = spark.createDataFrame([(k,) for k in DATES], "text string")
    got = {r.text: r.day for r in df.select("text", parse_date(F.col("text")).alias("day")).collect()}
    assert got == DATES


def test_categories_keep_unknown_texts(spark):
    df = spark.createDataFrame([("n",), (" CANCELED",), ("P",), (None,)], "status string")
    assert values(standardise.standardise_categories(df, "service_delivery"), "status") == [
        "No-Show", "Cancelled", "P", None,
    ]
    gender = spark.createDataFrame([("n",), ("p",), ("Other",)], "gender string")
    assert values(standardise.standardise_categories(gender, "beneficiaries"), "gender") == [
        "Non-Binary", "Prefer Not to Say", "Other",
    ]
    programs = spark.createDataFrame([("Active",), ("at RISK",)], "status string")
    assert values(standardise.standardise_categories(programs, "programs"), "status") == [
        "Active", "At Risk",
    ]


def test_unmapped_values(spark):
    rows = [(v,) for v in ["zeta", "beta ", "alpha", "gamma", "delta", "eps", "alpha", "Male", None]]
    (row,) = standardise.unmapped_values(
        spark.createDataFrame(rows, "gender string"), "beneficiaries"
    ).collect()
    assert (row.column_name, row.n_unmapped) == ("gender", 6)
    assert row["sample"] == ["alpha", "beta", "delta", "eps", "gamma"]


def test_bounds_are_inclusive_and_text_stays(spark):
    df = spark.createDataFrame(
        [("0", "0"), ("110", "20"), ("111", "21"), ("-1", "1"), ("abc", "5d"), (None, None)],
        "age string, household_size string",
    )
    out = standardise.null_outliers(df)
    assert values(out, "age") == ["0", "110", None, None, "abc", None]
    assert values(out, "household_size") == [None, "20", None, "1", "5d", None]


def test_score_above_its_maximum(spark):
    df = spark.createDataFrame([("90", "100"), ("101", "100"), ("50", None)], "score string, max_score string")
    assert values(standardise.null_outliers(df), "score") == ["90", None, "50"]


@pytest.mark.parametrize("seed", range(4))
def test_median_is_exact(spark, seed):
    rng = random.Random(seed)
    numbers = [rng.choice([rng.uniform(-5, 5), rng.randint(-3, 3), rng.uniform(0, 1e6), 0.001]) for _ in range(rng.randint(1, 60))]
    rows = [(repr(float(n)), str(rng.randint(0, 4))) for n in numbers] + [(None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = {r.column_name: r["median"] for r in impute.exact_medians(df, ["a", "b"]).collect()}
    assert got["a"] == statistics.median(numbers)
    assert got["b"] == statistics.median([float(b) for _, b in rows[:-1]])


def test_median_fills_only_columns_with_gaps(spark):
    df = spark.createDataFrame([("1", "1"), ("4", "abc"), (None, "3")], "x string, y string")
    out = impute.impute_columns(df, {"x": "median", "y": "median"}).collect()
    assert [r.x for r in out] == [1.0, 4.0, 2.5]
    # y has no gap: its unreadable text is not filled.
    assert [r.y for r in out] == [1.0, None, 3.0]


def test_approximate_median(spark):
    df = spark.range(1001).select(F.col("id").cast("string").alias("x"))
    (row,) = impute.approximate_medians(df, ["x"]).collect()
    assert abs(row["median"] - 500) <= 1


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "x string")
    assert values(impute.impute_columns(df, {"x": "mode"}), "x")[4] == "a"


def test_unknown_strategy_is_an_error(spark):
    with pytest.raises(ValueError):
        impute.impute_columns(spark.range(1), {"id": "forward_fill"})


def test_dedup_null_keys_match_and_first_stays(spark):
    df = spark.createDataFrame(
        [("B2", " Asha", None, "1"), ("B1", "ASHA", None, "1"), ("B3", "Asha", "7", "1"),
         ("B4", "Asha", None, None), ("B1-DUP", "x", "y", "z")],
        "beneficiary_id string, full_name string, phone string, region_id string",
    )
    out = dedup.deduplicate(df, "beneficiaries", "beneficiary_id")
    assert sorted(values(out, "beneficiary_id")) == ["B1", "B3", "B4"]


def test_dedup_cuts_groups_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("staff_id"),
        F.when(F.col("id") >= 0, "same").otherwise("other").alias("full_name"),
        F.lit(None).cast("string").alias("phone"),
    )
    out = dedup.deduplicate(df, "staff", "staff_id")
    plan = plan_of(out)
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")
    assert out.count() == 1


def test_key_repeats_of_a_hot_key(spark):
    df = spark.range(3000).select(
        F.format_string("%05d", "id").alias("staff_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("full_name"),
        F.lit(None).cast("string").alias("phone"),
    )
    repeats = dedup.key_repeats(df, ["full_name", "phone"], "staff_id")
    assert repeats.count() == 999
    assert values(repeats.select("first_id").distinct(), "first_id") == ["00000"]


def test_references(spark):
    child = spark.createDataFrame(
        [("c1", "p1"), ("c2", "gone"), ("c3", None), ("c4", "gone"), ("c5", "p2")], "id string, parent string"
    )
    parent = spark.createDataFrame([("p1",), ("p2",), ("p2",), (None,)], "key string")
    out = references.check_reference(child, "parent", parent, "key", "id")
    assert {r.id: r.parent for r in out.collect()} == {
        "c1": "p1", "c2": None, "c3": None, "c4": None, "c5": "p2",
    }


def test_casts(spark):
    df = spark.createDataFrame(
        [("34.0", " x ", "1.5"), ("12.5", "y", "abc"), ("7d", None, "1e3"), ("99999999999", "z", None)],
        "age string, notes string, score string",
    )
    out = standardise.cast_types(df)
    assert dict(out.dtypes) == {"age": "int", "notes": "string", "score": "double"}
    assert values(out, "age") == [34, 13, None, None]
    assert values(out, "notes") == ["x", "y", None, "z"]
    assert values(out, "score") == [1.5, None, 1000.0, None]


FUNDING = [
    ("F1", "D1", "P1", "500.255", "INR", "01/04/2023", "FY2023-24", None),
    ("F2", "D9", "P1", "50", "INR", "01/04/2023", "FY2023-24", "Grant"),
    ("F3", "D1", "P1", "900.10", "INR", "01/04/2023 ", "FY2023-24", "Grant"),
    ("F1-DUP", "D1", "P1", "500", "INR", "01/04/2023", "FY2023-24", None),
]


def test_one_table_end_to_end(spark):
    raw = spark.createDataFrame(FUNDING, model.raw_schema("funding"))
    donors = spark.createDataFrame([("D1",)], "donor_id string")
    programs = spark.createDataFrame([("P1",)], "program_id string")
    out, keys, audit = clean_table("funding", raw, {"donors": donors, "programs": programs})
    assert sorted(values(keys, "funding_id")) == ["F1", "F2"]
    assert [f.dataType for f in out.schema] == [f.dataType for f in model.clean_schema("funding")]
    rows = {r.funding_id: r for r in out.collect()}
    # F3 repeats F1 once blanks around the key are gone.
    assert set(rows) == {"F1", "F2"}
    assert rows["F1"].grant_type == "Unknown"
    assert rows["F1"].disbursement_date == dt.date(2023, 4, 1)
    assert rows["F2"].donor_id is None and rows["F2"].amount_inr is None
    details = [r.details for r in audit().orderBy("step_no").collect()]
    assert details == [
        "1 rows dropped whose key has the duplicate tag | 1 rows dropped that repeat the key of "
        "an earlier one: ['donor_id', 'program_id', 'disbursement_date']",
        "disbursement_date: 2 values are dates now",
        "",
        "amount_inr: 1 values outside 100.0 to 100000000.0, now NULL",
        "grant_type: 1 gaps got the text Unknown",
        "donor_id: 1 references without a parent, now NULL",
        "",
        "amount_inr: now double",
    ]


def test_empty_table(spark):
    raw = spark.createDataFrame([], model.raw_schema("beneficiaries"))
    out, _, audit = clean_table("beneficiaries", raw, {})
    assert out.count() == 0
    assert all(r.rows_before == 0 and r.rows_after == 0 for r in audit().collect())


def _as_text(df):
    return df.select(*[F.col(c).cast("string") for c in df.columns])


def test_cleaning_is_idempotent(dirty):
    """For people; facts keyed by a reference may lose rows once it is NULL."""
    once = clean(dirty.all()).tables
    twice = clean({name: _as_text(df) for name, df in once.items()}).tables
    first, second = once["beneficiaries"].collect(), twice["beneficiaries"].collect()
    assert sorted(map(str, first)) == sorted(map(str, second))


def test_no_orphan_is_left_and_keys_survive(dirty):
    tables = clean(dirty.all()).tables
    services, people = tables["service_delivery"], tables["beneficiaries"]
    orphans = references.orphan_keys(services, "beneficiary_id", people, "beneficiary_id")
    assert orphans.count() == 0
    kept = dedup.deduplicate(dirty["beneficiaries"], "beneficiaries", "beneficiary_id")
    assert people.select("beneficiary_id").exceptAll(kept.select("beneficiary_id")).count() == 0
    assert people.count() == kept.count()


def test_staged_run_gives_the_same(dirty, tmp_path):
    lazy, staged = clean(dirty.all()), clean(dirty.all(), stage_dir=str(tmp_path))
    for name, df in lazy.tables.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, staged.tables[name].collect()))
    assert sorted(map(str, lazy.audit.collect())) == sorted(map(str, staged.audit.collect()))
    # Rows and audit come from what was written, not from the raw tables.
    for df in (*staged.tables.values(), staged.audit):
        plan = plan_of(df)
        assert str(tmp_path) in plan and SMALL not in plan


def test_missing_tables_are_skipped_and_the_log_passes(spark, dirty):
    log = spark.createDataFrame([("L1",)], "log_id string")
    result = clean({"regions": dirty["regions"], "data_quality_log": log, "other": log})
    assert set(result.tables) == {"regions", "data_quality_log"}
    with pytest.raises(ValueError):
        clean({"other": log})


def test_schema_check(spark):
    raw = spark.createDataFrame(
        [("D1", None, "x"), ("D1", "n", "2020-01-01"), (None, "m", None)],
        "donor_id string, donor_name string, onboarded_date string",
    )
    rows = {r.column_name: r for r in check_table(raw, "donors").collect()}
    assert (rows["donor_id"].n_null_violations, rows["donor_id"].n_repeated_keys) == (1, 1)
    assert rows["donor_name"].n_null_violations == 1
    assert rows["onboarded_date"].n_uncastable == 1 and rows["onboarded_date"].n_null_violations == 0
    assert rows["country"].is_present == 0


def test_infinite_texts_are_no_numbers(spark):
    df = spark.createDataFrame([("1e999",), ("4",), ("6",), (None,)], "age string")
    filled = impute.impute_columns(df, {"age": "median"})
    assert sorted(str(r.age) for r in filled.collect()) == ["4.0", "5.0", "5.0", "6.0"]


def test_log_ids_are_unique_where_keys_repeat(spark):
    rows = [("B-1-DUP", "a"), ("B-1-DUP", "b"), ("B-2", "c")]
    people = spark.createDataFrame(rows, "beneficiary_id string, phone string")
    log = quality.issue_log({"beneficiaries": people}, dt.date(2025, 1, 1)).collect()
    tagged = [r for r in log if r.record_id == "B-1-DUP"]
    assert len(tagged) >= 2 and len({r.log_id for r in log}) == len(log)


def test_orphans_of_the_log_are_those_of_the_cleaner(spark):
    people = spark.createDataFrame([("B-1-DUP",), ("B-2 ",)], "beneficiary_id string")
    services = spark.createDataFrame([("S1", "B-1-DUP"), ("S2", "B-2")], "delivery_id string, beneficiary_id string")
    tables = {"beneficiaries": people, "service_delivery": services}
    found = quality.all_issues(tables).filter(F.col("issue_type") == quality.ORPHAN).collect()
    assert [r.record_id for r in found] == ["S1"]


def test_medians_of_values_in_one_slice(spark):
    """Distinct values that share a slice are cut into pieces; the exact middle is found."""
    for offset, step in ((0.0, 1e-12), (5000.0, 1e-6), (-5000.0, 1e-6)):
        numbers = [offset + step * (i * 7919 % 20011) for i in range(20010)]
        df = spark.createDataFrame([(x,) for x in numbers] + [(None,)], "age double")
        (row,) = impute.exact_medians(df, ["age"]).collect()
        assert row.median == statistics.median(numbers) and row.has_gap


def test_medians_across_two_slices_and_of_nothing(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (90.0, None), (1000.0, None)], "a double, b double")
    got = {r.column_name: r for r in impute.exact_medians(df, ["a", "b"]).collect()}
    assert got["a"].median == 46.0 and not got["a"].has_gap
    assert got["b"].median is None and got["b"].has_gap
