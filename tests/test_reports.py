"""Reports, views, dashboard data and issue detection."""

import random

import pytest
from pyspark.sql import functions as F

from tallygrove.operators import joins, quality
from tallygrove.operators.dimensions import one_dimension_totals
from tallygrove.plans import blocks, dashboard, kpis, views
from tallygrove.sources import csv_dir, sinks
from tests.conftest import plan_of


def test_view_shapes(sample):
    widths = {name: len(df.columns) for name, df in views.build_views(sample).items()}
    assert widths == {
        "v_cost_per_impact": 20, "v_programme_progress": 23, "v_beneficiary_360": 21,
        "v_outcome_effectiveness": 19, "v_financial_overview": 16,
    }


def test_registered_views_can_be_queried(spark, sample):
    catalog = {r.view_name: r.n_rows for r in views.register_views(spark, sample).collect()}
    for name, n in catalog.items():
        assert spark.sql(f"select count(*) n from {name}").first().n == n


def test_stacked_dimensions_equal_a_union(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["x", "y", None, "Unknown"]), rng.choice([1, 0, None]), rng.randint(0, 9)) for _ in range(300)]
    df = spark.createDataFrame(rows, "a string, b int, n bigint")
    stacked = one_dimension_totals(df, {"A": "a", "B": "b"}, ["n"])
    union = df.groupBy(F.col("a").alias("v")).agg(F.sum("n").alias("n")).select(
        F.lit("A").alias("dimension"), "v", "n"
    ).union(
        df.groupBy(F.col("b").cast("string").alias("v")).agg(F.sum("n").alias("n")).select(F.lit("B"), "v", "n")
    )
    assert sorted(map(str, map(tuple, stacked.collect()))) == sorted(map(str, map(tuple, union.collect())))


def test_people_are_reduced_before_dimensions_join(sample):
    plan = plan_of(kpis.person_groups(sample))
    # Dimension joins stand above (before, in the text) the aggregate of people.
    assert plan.index("region_id") < plan.index("HashAggregate")


def test_a_post_test_must_follow(spark):
    rows = [
        ("a", 1, "Pre-Test", "2023-01-02", 10.0), ("a", 2, "Pre-Test", "2023-01-01", 20.0),
        ("a", 3, "Post-Test", "2023-02-01", 30.0), ("a", 4, "Post-Test", "2023-02-01", 40.0),
        ("b", 5, "Pre-Test", "2023-03-01", 10.0), ("b", 6, "Post-Test", "2023-03-01", 50.0),
        ("c", 7, "Pre-Test", "2023-03-01", 0.0), ("c", 8, "Post-Test", "2023-03-05", 50.0),
        ("c", 9, "Post-Test", None, 70.0), ("d", 10, "Post-Test", "2023-03-05", 50.0),
        ("e", 11, "Pre-Test", None, 5.0), ("e", 12, "Pre-Test", "2023-01-01", 5.0),
        ("e", 13, "Post-Test", "2023-02-01", 5.0),
    ]
    df = spark.createDataFrame(
        rows, "beneficiary_id string, assessment_id int, assessment_type string, d string, score double"
    ).select("*", F.col("d").cast("date").alias("assessment_date"), F.lit(50.0).alias("max_score"))
    got = {r.beneficiary_id: r for r in blocks.matched_pairs(df).collect()}
    assert set(got) == {"a", "c"}
    assert (got["a"].pre_tenths, got["a"].post_tenths, got["a"].days_between_tests) == (400, 600, 31)
    assert got["a"].effect_tenths == 500
    assert got["c"].effect_tenths is None and got["c"].outcome_direction == "Improved"


def test_hot_person_is_reduced_on_the_map_side(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("beneficiary_id"),
        (F.col("id") % 7).alias("intervention_id"), F.col("id").alias("delivery_id"),
    )
    per_person = blocks.services_per_person(df)
    hot = per_person.filter("beneficiary_id = -1").first()
    assert (hot.services_received, hot.unique_interventions) == (667, 7)
    assert "partial_count" in plan_of(per_person)


def test_grid_is_complete(spark):
    left = spark.range(57).select(F.col("id").alias("p"))
    right = spark.createDataFrame([("x",), ("y",), (None,)], "f string")
    out = joins.grid(left, right, "p")
    assert out.count() == 171 and out.distinct().count() == 171


def test_broadcast_only_what_was_measured_small(spark, monkeypatch):
    dims = {"d": spark.range(1000)}
    assert joins.measured(dims)["d"].small
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 100)
    assert not joins.measured(dims)["d"].small
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 999)
    assert not joins.measured(dims)["d"].small


def test_detail_pages_by_number_and_by_last_row(sample):
    people = views.v_beneficiary_360(sample)
    first, second = dashboard.detail_page(people, 1).collect(), dashboard.detail_page(people, 2).collect()
    assert len(first) == len(second) == 20
    after = (first[-1].services_received, first[-1].beneficiary_id)
    assert dashboard.detail_page(people, after=after).collect() == second
    assert "TakeOrdered" in plan_of(dashboard.detail_page(people, 2))


def test_filters(spark):
    df = spark.createDataFrame(
        [("FY2022-23", "P", "S1"), ("FY2023-24", "P", "S1"), ("FY2023-24", "Q", "S2")],
        "fiscal_year string, program_name string, state string",
    )
    assert dashboard.apply_filters(df, fiscal_year=dashboard.LATEST).count() == 2
    assert dashboard.apply_filters(df, programs=["P"], state="S1", sector="none such").count() == 2
    assert dashboard.apply_filters(df.drop("fiscal_year"), fiscal_year="FY1").count() == 3


def test_empty_views_give_cards(spark, sample):
    people = views.v_beneficiary_360(sample).limit(0)
    row = dashboard.card_reach(people).first()
    assert (row.reached, row.registered, row.activation_pct, row.rag_status) == (0, 0, 0.0, "RED")


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


@pytest.mark.parametrize("seed, forms_up_to", [(0, 128), (1, 128), (2, 5), (3, 0), (4, 8)])
def test_name_variants_against_all_pairs(spark, seed, forms_up_to):
    rng = random.Random(seed)
    names = ["asha", "ashaa", "", "a", "kumar", "kumer", "kumaar", "singh", "sing", "sigh", "ravi"]
    rows = [(f"B{i:03d}", rng.choice(names) + rng.choice(["", "x", "yz"]), rng.choice(["1", "2", None])) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, name string, region string")
    found = quality.name_variants(df, "id", "name", "region", forms_up_to=forms_up_to).collect()
    got = {r.record_id: (r.edits, r.near_id, r.near_spelling) for r in found}
    first = {}
    for key, name, region in rows:
        first.setdefault((region, name), key)
    want = {}
    for key, name, region in rows:
        near = [
            (_distance(name, other), other_key, other)
            for (r, other), other_key in first.items()
            if r == region and other_key < first[(region, name)] and 1 <= _distance(name, other) <= 2
        ]
        if near:
            want[key] = min(near)
    assert got == want


def test_very_long_names(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    rows = [("1", text), ("2", text[:2000] + "x" + text[2000:]), ("3", text[1:-1]), ("4", "q" + text[3:])]
    df = spark.createDataFrame([(*r, "1") for r in rows], "id string, name string, region string")
    got = {r.record_id: (r.near_id, r.edits) for r in quality.name_variants(df, "id", "name", "region").collect()}
    assert got == {"2": ("1", 1), "3": ("1", 2)}


def test_hot_name_does_not_multiply(spark):
    df = spark.range(3000).select(
        F.format_string("%05d", "id").alias("id"),
        F.when(F.col("id") % 3 == 0, "ram kumar").when(F.col("id") % 3 == 1, "ram kumer").otherwise(
            F.concat(F.lit("person number "), (F.col("id") * 7919).cast("string"))
        ).alias("name"),
        F.lit("1").alias("region"),
    )
    found = quality.name_variants(df, "id", "name", "region").filter("spelling = 'ram kumer'")
    assert found.count() == 1000


def _join_rows(plan):
    """Rows that each join of a finished plan has given."""
    name = plan.nodeName().split(" ")[0]
    if name == "AdaptiveSparkPlan":
        below = [plan.executedPlan()]
    elif name.endswith("QueryStage"):
        below = [plan.plan()]
    else:
        below = [plan.children().apply(i) for i in range(plan.children().size())]
    own = [plan.metrics().apply("numOutputRows").value()] if "Join" in name else []
    return own + [n for one in below for n in _join_rows(one)]


def test_dense_names_are_not_paired(spark):
    n = 2000
    df = spark.range(n).select(
        F.format_string("%05d", "id").alias("id"), F.format_string("name %05d", "id").alias("name"), F.lit("1").alias("region")
    )
    found = quality.name_variants(df, "id", "name", "region")
    assert len(found.collect()) == n - 1
    assert max(_join_rows(found._jdf.queryExecution().executedPlan())) <= 20 * n


def test_issue_ids_are_unique(dirty):
    import datetime as dt

    log = quality.issue_log(dirty.all(), dt.date(2025, 1, 1))
    assert log.count() == log.select("log_id").distinct().count()


def test_csv_folder_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv_dir.load_csv_tables(spark, str(tmp_path / "none"))
    (tmp_path / "notes.txt").write_text("x")
    with pytest.raises(ValueError):
        csv_dir.load_csv_tables(spark, str(tmp_path))


def test_csv_files_and_missing_marks(spark, tmp_path):
    (tmp_path / "donors.csv").write_text('donor_id,donor_name,country\nD1,"A, ""B""",NA\nD2,, IN\n')
    (tmp_path / "staff.csv").write_text("staff_id\nS1\n")
    tables = csv_dir.load_csv_tables(spark, str(tmp_path))
    assert sorted(tables) == ["donors", "staff"]
    assert [tuple(r) for r in tables["donors"].collect()] == [("D1", 'A, "B"', None), ("D2", None, " IN")]


def test_tables_are_partitioned_by_year(spark, sample, tmp_path):
    sinks.write_tables({"funding": sample["funding"], "regions": sample["regions"]}, str(tmp_path))
    back = spark.read.parquet(str(tmp_path / "funding"))
    assert back.count() == sample["funding"].count()
    plan = plan_of(back.filter("fiscal_year = 'FY1996-97'"))
    assert "PartitionFilters: [isnotnull(fiscal_year" in plan


def test_scans_read_only_what_is_used(spark, sample):
    plan = plan_of(blocks.program_spend(sample["expenses"]))
    assert "l_tax" not in plan and "l_comment" not in plan


def test_managed_tables(spark, sample, tmp_path):
    spark.sql(f"create database if not exists grove location '{tmp_path}'")
    try:
        sinks.save_tables({"funding": sample["funding"]}, "grove")
        assert spark.table("grove.funding").count() == sample["funding"].count()
    finally:
        spark.sql("drop database grove cascade")


def test_all_dashboard_data(sample):
    data = dashboard.datasets(sample, fiscal_year="FY1996-97", sector="Sector 3")
    counts = {name: df.count() for name, df in data.items()}
    assert counts["card_cost"] == counts["card_reach"] == counts["burn_rate"] == 1
    assert counts["card_achievement"] == counts["quarter_growth"] == 4
    # The first quarter of the year still has one before it.
    assert data["card_achievement"].filter("change_pp is null").count() == 0
    assert data["cost_bars"].select("sector").distinct().count() == 1


def test_star_join_by_declared_kind(spark):
    tables = {
        "interventions": spark.createDataFrame(
            [("I1", "P1", "S1"), ("I2", "P1", None), ("I3", "P9", "S1"), ("I4", None, "S9")],
            "intervention_id string, program_id string, staff_id string",
        ),
        "programs": spark.createDataFrame([("P1", "One")], "program_id string, program_name string"),
        "staff": spark.createDataFrame([("S1", "Asha")], "staff_id string, full_name string"),
    }
    out = joins.star_join(tables, "interventions").orderBy("intervention_id").collect()
    assert [tuple(r) for r in out] == [("I1", "P1", "S1", "One", "Asha"), ("I2", "P1", None, "One", None)]
    assert joins.star_join({"regions": tables["staff"]}, "regions") is tables["staff"]


def test_declared_ddl(spark):
    from tallygrove.operators.schema_check import declared_ddl

    assert declared_ddl("expenses").startswith("expense_id STRING NOT NULL")
    assert "amount_inr DECIMAL(15,2) NOT NULL" in declared_ddl("expenses")
