"""The five flat views.

Fixed values: view and column names.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.functions import labels
from tallygrove.functions.numbers import round_half_away, rounded_percent, sum_money, sum_money_when
from tallygrove.operators.joins import Side, grid, join_dimension, measured
from tallygrove.plans import blocks
from tallygrove.plans.blocks import Tables


def v_cost_per_impact(tables: Tables) -> DataFrame:
    """One row per program, indicator and fiscal year."""
    regions = tables["regions"].select("region_id", "state", "district", "region_type")
    return blocks.cost_rows(tables).join(regions, "region_id", "left").select(
        "program_id", "program_name", "sector", "program_status", "state", "district",
        "region_type", "iris_id", "indicator_name", "indicator_unit", "indicator_category",
        "fiscal_year", "total_target", "total_actual", "achievement_pct", "total_spend_inr",
        "cost_per_unit_inr", "personnel_pct", "me_investment_pct", "efficiency_rank",
    )


def v_programme_progress(tables: Tables) -> DataFrame:
    """One row per program, indicator and reported quarter."""
    regions = tables["regions"].select(F.col("region_id").alias("__region"), "state", "region_type")
    rows = blocks.quarter_rows(tables)
    return join_dimension(rows, Side(regions, small=False), "region_id", "__region").select(
        "outcome_id", "program_id", "program_name", "sector", "program_status", "state",
        "region_type", "iris_id", "indicator_name", "indicator_category",
        "reporting_period", "quarter_num", "fiscal_year", "target_value", "actual_value",
        "achievement_pct", "prev_quarter_actual", "cumulative_actual", "cumulative_target",
        "rag_status", "verification_status", "data_source", "recency_rank",
    )


def dimension_sides(tables: Tables, measure: bool = True) -> dict[str, Side]:
    """Programs and regions for joins to people; measured once, where asked for."""
    programs = tables["programs"].select(
        F.col("program_id").alias("__program"), "program_id", "program_name", "sector"
    )
    regions = tables["regions"].select(
        F.col("region_id").alias("__region"), "state", "district", "region_type"
    )
    dims = {"programs": programs, "regions": regions}
    return measured(dims) if measure else {k: Side(df, small=False) for k, df in dims.items()}


def _with_dimensions(people: DataFrame, sides: Mapping[str, Side]) -> DataFrame:
    """People with their program and region; an unmatched program id is NULL."""
    joined = join_dimension(people, sides["programs"], "__person_program", "__program")
    return join_dimension(joined, sides["regions"], "region_id", "__region")


def v_beneficiary_360(tables: Tables, sides: Mapping[str, Side] | None = None) -> DataFrame:
    """One row per person with service and assessment totals.

    ``sides`` are those of :func:`dimension_sides`; without, dimensions are
    measured now, which runs a small job.

    ``latest_score_pct`` is the best score; the name is part of the contract.
    """
    people = tables["beneficiaries"].withColumnRenamed("program_id", "__person_program")
    if "registration_date" not in people.columns:
        people = people.withColumn("registration_date", F.lit(None).cast("date"))
    services = blocks.services_per_person(tables["service_delivery"])
    tests = blocks.assessments_per_person(tables["assessments"])
    zero = F.lit(0).cast("bigint")
    counted = people.join(services, "beneficiary_id", "left").join(tests, "beneficiary_id", "left")
    return (
        _with_dimensions(counted, sides or dimension_sides(tables))
        .select(
            "beneficiary_id",
            "full_name",
            "age",
            labels.age_cohort(F.col("age")).alias("age_cohort"),
            "gender",
            "education_level",
            "income_bracket",
            "household_size",
            labels.disability_status(F.col("is_disabled")).alias("disability_status"),
            "registration_date",
            "program_id",
            "program_name",
            "sector",
            "state",
            "district",
            "region_type",
            F.coalesce("services_received", zero).alias("services_received"),
            F.coalesce("unique_interventions", zero).alias("unique_interventions"),
            labels.beneficiary_status(F.col("services_received")).alias("beneficiary_status"),
            F.coalesce("assessments_taken", zero).alias("assessments_taken"),
            "latest_score_pct",
        )
    )


def v_outcome_effectiveness(
    tables: Tables, sides: Mapping[str, Side] | None = None
) -> DataFrame:
    """One row per person with a matched pre and post test; ``sides`` as for people."""
    people = tables["beneficiaries"].select(
        "beneficiary_id", "full_name", "gender", "age", "income_bracket", "is_disabled",
        "region_id", F.col("program_id").alias("__person_program"),
    )
    pairs = blocks.matched_pairs(tables["assessments"]).join(people, "beneficiary_id")
    return (
        _with_dimensions(pairs, sides or dimension_sides(tables))
        .select(
            "beneficiary_id",
            "full_name",
            "gender",
            "age",
            "income_bracket",
            labels.pwd_flag(F.col("is_disabled")).alias("is_pwd"),
            "program_id",
            "program_name",
            "sector",
            "state",
            "region_type",
            "pre_date",
            (F.col("pre_tenths") / 10.0).alias("pre_score_pct"),
            "post_date",
            (F.col("post_tenths") / 10.0).alias("post_score_pct"),
            (F.col("gain_tenths") / 10.0).alias("improvement_pct"),
            (F.col("effect_tenths") / 10.0).alias("effect_size_pct"),
            "days_between_tests",
            "outcome_direction",
        )
    )


def fiscal_years(tables: Tables) -> DataFrame:
    """Every fiscal year seen in money going in or out."""
    return (
        tables["expenses"].select("fiscal_year")
        .union(tables["funding"].select("fiscal_year"))
        .distinct()
    )


def _years_of(sums: DataFrame) -> DataFrame:
    """The fiscal years of sums per program and year.

    A condition that always holds keeps every column of the sums in use, so
    that this and their join to the grid share one scan and shuffle.
    """
    others = [c for c in sums.columns if c != "fiscal_year"]
    counted = sums.groupBy("fiscal_year").agg(F.count_if(F.hash(*others) == 0).alias("n"))
    return counted.filter("n >= 0").select("fiscal_year")


def v_financial_overview(tables: Tables) -> DataFrame:
    """Funding, spend and balance for every program in every fiscal year seen."""
    amount, category = F.col("amount_inr"), F.col("category")
    funding = tables["funding"].groupBy("program_id", "fiscal_year").agg(
        sum_money(amount).alias("funded"),
        F.count_distinct("donor_id").alias("donors"),
    )
    spend = tables["expenses"].groupBy("program_id", "fiscal_year").agg(
        sum_money(amount).alias("spent"),
        sum_money_when(category == blocks.PERSONNEL, amount).alias("personnel"),
        sum_money_when(category == blocks.FIELD, amount).alias("field"),
        sum_money_when(category == blocks.MONITORING, amount).alias("me"),
        sum_money_when(category == blocks.OVERHEAD, amount).alias("overhead"),
    )
    regions = tables["regions"].select("region_id", "state", "region_type")
    programs = tables["programs"].join(regions, "region_id", "left")
    none = F.lit(0.0)
    funded, spent = F.coalesce("funded", none), F.coalesce("spent", none)

    def beside(rows: DataFrame, sums: DataFrame) -> DataFrame:
        # NULL-safe, so that the optimizer adds no filter to one of the two uses of
        # the sums; money without a year still belongs to no year of the grid.
        right = sums.withColumnsRenamed({"program_id": "__program", "fiscal_year": "__year"})
        values = [c for c in right.columns if not c.startswith("__")]
        same = F.col("program_id").eqNullSafe(F.col("__program"))
        same &= F.col("fiscal_year").eqNullSafe(F.col("__year"))
        dated = {c: F.when(F.col("fiscal_year").isNotNull(), F.col(c)) for c in values}
        return rows.join(right, same, "left").drop("__program", "__year").withColumns(dated)

    years = _years_of(funding).union(_years_of(spend)).distinct()
    return (
        beside(beside(grid(programs, years, "program_id"), funding), spend)
        .select(
            "program_id",
            "program_name",
            "sector",
            F.col("status").alias("program_status"),
            "state",
            "region_type",
            "fiscal_year",
            funded.alias("total_funding_inr"),
            F.coalesce("donors", F.lit(0).cast("bigint")).alias("donor_count"),
            spent.alias("total_expense_inr"),
            round_half_away(funded - spent, 2).alias("net_balance_inr"),
            rounded_percent(spent, funded).alias("burn_rate_pct"),
            F.coalesce("personnel", none).alias("personnel_inr"),
            F.coalesce("field", none).alias("field_inr"),
            F.coalesce("me", none).alias("me_inr"),
            F.coalesce("overhead", none).alias("overhead_inr"),
        )
    )


VIEWS = {
    "v_cost_per_impact": v_cost_per_impact,
    "v_programme_progress": v_programme_progress,
    "v_beneficiary_360": v_beneficiary_360,
    "v_outcome_effectiveness": v_outcome_effectiveness,
    "v_financial_overview": v_financial_overview,
}


def build_views(tables: Tables, measure: bool = True) -> dict[str, DataFrame]:
    """All five views; dimensions are measured once for all, or left to Catalyst."""
    sides = dimension_sides(tables, measure)
    people = ("v_beneficiary_360", "v_outcome_effectiveness")
    return {name: build(tables, sides) if name in people else build(tables) for name, build in VIEWS.items()}


def register_views(spark: SparkSession, tables: Tables) -> DataFrame:
    """(Re)create the five temp views; report name, rows and columns of each.

    A view outlives what was measured, so it carries no broadcast hint.
    """
    views = build_views(tables, measure=False)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return view_catalog(views)


def view_catalog(views: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("view_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in views.items()
    ]
    return reduce(DataFrame.unionByName, counts)
