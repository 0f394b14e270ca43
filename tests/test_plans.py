"""Plans that must not read their input twice."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from tallygrove.functions.numbers import to_number
from tallygrove.functions.text import parse_date
from tallygrove.operators import impute, standardise
from tallygrove.operators.edits import apply_edits
from tallygrove.plans import clean, dashboard, views
from tallygrove.rules import DEFAULT_RULES
from tests.conftest import SMALL, plan_of


def final_plan(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def test_medians_leave_nothing_to_compute(dirty):
    """Their rounds run when they are asked for; fills are plain numbers, not further reads."""
    people = standardise.null_outliers(dirty["beneficiaries"])
    assert SMALL not in plan_of(impute.exact_medians(people, ["age", "household_size"]))
    filled = impute.impute_columns(people, {"age": "median", "household_size": "median", "gender": "mode"})
    assert plan_of(filled).count("customer.parquet") == plan_of(people).count("customer.parquet")


def test_unmapped_values_share_the_distinct(dirty):
    plan = final_plan(standardise.unmapped_values(dirty["beneficiaries"], "beneficiaries"))
    assert "ReusedExchange" in plan


def test_trend_lines_share_the_quarter_sums(sample):
    assert "ReusedExchange" in final_plan(dashboard.trend_top(views.v_programme_progress(sample)))


def test_cost_bars_run_the_view_once(sample):
    plan = final_plan(dashboard.cost_bars(views.v_cost_per_impact(sample)))
    assert "Subquer" not in plan and "Window [sum" not in plan
    assert plan.count("lineitem.parquet") == 2  # outcomes and expenses, once each


def test_financial_overview_reads_each_fact_once(sample):
    plan = final_plan(views.v_financial_overview(sample))
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("orders.parquet") == 1


def test_tables_with_categories_shuffle_their_keys_once(dirty, tmp_path):
    """Medians or not: the search for unmapped texts reads the rows that are left from files."""
    clean.clean(dirty.all(), stage_dir=str(tmp_path))
    for table in ("beneficiaries", "service_delivery", "assessments"):
        assert (Path(tmp_path) / table / "standardised").is_dir(), table


def test_whole_numbers_are_read_once(spark):
    """A cast to a whole number matches two patterns, and reads a plain one once."""
    df = spark.createDataFrame([("7",)], "age string")
    plan = plan_of(apply_edits(df, standardise.cast_edits(df, DEFAULT_RULES)))
    assert plan.count("RLIKE") == 2


def test_every_part_of_a_date_is_spelt_once(spark):
    df = spark.createDataFrame([("5/6/2023",)], "day string")
    plan = plan_of(df.select(parse_date(F.col("day")).alias("day")))
    assert len(re.findall("regexp_extract", plan)) <= 6 and plan.count("RLIKE") <= 5


def test_usual_dates_are_read_as_the_patterns_do(spark):
    """By place only where the patterns give the same: odd signs, blanks and marks are no dates."""
    days = {
        "2023/05/06": "2023-05-06", "05.06.2023": "2023-06-05", "05/25/2023": "2023-05-25", "20230506": "2023-05-06",
        "05-Jan-68": "2068-01-05", "05-JAN-69": "1969-01-05", "5-6-2023": "2023-06-05", "05/06/23": "2023-06-05",
        "2023/05/1T": None, "1T/03/2021": None, "T5/03/2021": None, "+202/05/06": None, "-2023005": None,
        "2023051T": None, "05-Foo-23": None, "05-Jan/23": "2023-01-05", "31/04/2021": None, "05/06.2023": None,
    }
    df = spark.createDataFrame([(t,) for t in days], "text string")
    got = df.select("text", parse_date(F.col("text")).cast("string").alias("day")).collect()
    assert {r.text: r.day for r in got} == days


def test_numbers_at_the_limits(spark):
    texts = {"9" * 300: True, "9" * 308: True, "9" * 400: False, "1e999": False, "5d": False, " 12. ": True, ".5": True}
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select("text", to_number(F.col("text")).isNotNull().alias("known")).collect()
    assert {r.text: r.known for r in got} == texts
    ages = {"2147483647.4": 2**31 - 1, "2147483647.5": None, "-2147483648.5": -(2**31), "1e30": None, "2.5": 3}
    df = spark.createDataFrame([(t,) for t in ages], "age string")
    cast = apply_edits(df.withColumn("text", F.col("age")), standardise.cast_edits(df, DEFAULT_RULES))
    assert {r.text: r.age for r in cast.collect()} == ages
