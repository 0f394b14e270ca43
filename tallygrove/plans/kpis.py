"""The four KPI reports.

Fixed values: dimension names, fallback labels and output columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.functions import labels
from tallygrove.functions.numbers import (
    count_where,
    round_half_away,
    rounded_percent,
    safe_ratio,
)
from tallygrove.operators.dimensions import one_dimension_totals
from tallygrove.plans import blocks
from tallygrove.plans.blocks import Tables


def cost_per_impact(tables: Tables) -> DataFrame:
    """KPI 1: spend per unit of outcome, by program, indicator and fiscal year."""
    return (
        blocks.cost_rows(tables)
        .select(
            "program_name", "sector", "fiscal_year", "iris_id", "indicator_name",
            "indicator_unit", "total_target", "total_actual", "achievement_pct",
            "total_spend_inr", "cost_per_unit_inr", "personnel_pct", "me_investment_pct",
            "efficiency_rank",
        )
        .orderBy("iris_id", "efficiency_rank", "fiscal_year", "program_name", "indicator_name")
    )


def programme_progress(tables: Tables) -> DataFrame:
    """KPI 2: target against actual by quarter, with trend and RAG status."""
    actual, previous = F.col("actual_value"), F.col("prev_quarter_actual")
    return (
        blocks.quarter_rows(tables)
        .withColumns(
            {
                "cumulative_achievement_pct": rounded_percent(
                    F.col("cumulative_actual"), F.col("cumulative_target")
                ),
                "qoq_growth_pct": rounded_percent(actual - previous, previous),
                "momentum": labels.momentum(actual, previous),
            }
        )
        .select(
            "program_name", "sector", "program_status", "iris_id", "indicator_name",
            "indicator_category", "reporting_period", "fiscal_year", "quarter_num",
            "target_value", "actual_value", "achievement_pct", "cumulative_target",
            "cumulative_actual", "cumulative_achievement_pct", "prev_quarter_actual",
            "qoq_growth_pct", "momentum", "rag_status", "verification_status",
            "data_source", "recency_rank",
        )
        .orderBy("program_name", "iris_id", "fiscal_year", "quarter_num", "indicator_name")
    )


REACH_DIMENSIONS = {
    "Gender": "gender",
    "Age Cohort": "age_cohort",
    "Income Bracket": "income_bracket",
    "Region Type": "region_type",
    "Disability Status": "is_disabled",
    "Education Level": "education_level",
    "Program Sector": "sector",
    "State": "state",
}


def person_groups(tables: Tables) -> DataFrame:
    """People counted by their reporting attributes, with region and program.

    People meet their service counts by key and are then reduced to one row
    per combination of attributes; regions and programs are joined to that
    much smaller set.
    """
    services = blocks.services_per_person(tables["service_delivery"])
    people = tables["beneficiaries"].select(
        "beneficiary_id", "region_id", "program_id", "gender", "income_bracket",
        "education_level", "is_disabled", labels.age_cohort(F.col("age")).alias("age_cohort"),
    )
    active = F.coalesce(F.col("services_received"), F.lit(0)) > 0
    attributes = [c for c in people.columns if c != "beneficiary_id"]
    counted = (
        people.join(services, "beneficiary_id", "left")
        .groupBy(*attributes)
        .agg(
            F.count("*").alias("registered"),
            count_where(active).alias("active"),
            F.sum(F.when(active, F.col("services_received"))).alias("services"),
            F.sum(F.when(active, F.col("unique_interventions"))).alias("interventions"),
        )
    )
    regions = tables["regions"].select("region_id", "region_type", "state")
    programs = tables["programs"].select("program_id", "sector")
    return counted.join(regions, "region_id", "left").join(programs, "program_id", "left")


def _shown_value() -> Column:
    """The label of a raw value, by its dimension."""
    dimension, raw = F.col("dimension"), F.col("raw_value")
    return (
        F.when(dimension == "Disability Status", labels.disability_status(raw.cast("int")))
        .when(dimension == "Program Sector", F.coalesce(raw, F.lit("Unassigned")))
        .otherwise(F.coalesce(raw, F.lit("Unknown")))
    )


def demographic_reach(tables: Tables) -> DataFrame:
    """KPI 3: registered and active people by eight dimensions.

    Groups are formed on raw values: a missing value and the text 'Unknown'
    stay two rows.
    """
    totals = one_dimension_totals(
        person_groups(tables),
        REACH_DIMENSIONS,
        ["registered", "active", "services", "interventions"],
    )
    per_dimension = Window.partitionBy("dimension")
    registered, active = F.col("registered"), F.col("active")
    return totals.select(
        "dimension",
        _shown_value().alias("dimension_value"),
        registered.alias("total_registered"),
        active.alias("total_active"),
        rounded_percent(active, registered).alias("activation_rate_pct"),
        round_half_away(safe_ratio(F.col("services"), active), 1).alias("avg_services_per_active"),
        round_half_away(safe_ratio(F.col("interventions"), active), 1).alias(
            "avg_unique_interventions"
        ),
        rounded_percent(registered, F.sum(registered).over(per_dimension)).alias("pct_of_total"),
    ).orderBy("dimension", F.desc("total_registered"), "dimension_value")


def outcome_effectiveness(tables: Tables) -> DataFrame:
    """KPI 4: matched pre/post results by program and sector.

    Pairs are counted by program id before programs are joined; their sums of
    tenths then add up to the groups of the report.
    """
    people = tables["beneficiaries"].select(
        "beneficiary_id", "program_id", "gender", "is_disabled", "income_bracket"
    )
    direction = F.col("outcome_direction")
    per_program = (
        blocks.matched_pairs(tables["assessments"])
        .join(people, "beneficiary_id")
        .groupBy("program_id")
        .agg(
            F.count("*").alias("pairs"),
            F.sum("gain_tenths").alias("gain"),
            F.sum("pre_tenths").alias("pre"),
            F.sum("post_tenths").alias("post"),
            F.sum("effect_tenths").alias("effect"),
            F.count("effect_tenths").alias("effect_n"),
            F.sum("days_between_tests").alias("days"),
            count_where(direction == "Improved").alias("improved"),
            count_where(direction == "Declined").alias("declined"),
            count_where(direction == "No Change").alias("same"),
            count_where(F.col("gender") == "Female").alias("female"),
            count_where(F.col("is_disabled") == 1).alias("pwd"),
            count_where(F.lower("income_bracket").startswith("bpl")).alias("bpl"),
        )
    )
    programs = tables["programs"].select("program_id", "program_name", "sector")
    grouped = (
        per_program.join(programs, "program_id", "left")
        .groupBy("program_name", "sector")
        .agg(*[F.sum(c).alias(c) for c in per_program.columns if c != "program_id"])
    )

    def mean(total: str, n: str = "pairs") -> Column:
        return round_half_away(safe_ratio(F.col(total), F.col(n).cast("double") * 10.0), 1)

    return grouped.select(
        F.coalesce("program_name", F.lit("All Programs")).alias("program_name"),
        F.coalesce("sector", F.lit("All Sectors")).alias("sector"),
        F.col("pairs").alias("matched_pairs_count"),
        mean("gain").alias("avg_improvement_pct"),
        mean("pre").alias("avg_baseline_score"),
        mean("post").alias("avg_endline_score"),
        mean("effect", "effect_n").alias("avg_effect_size_pct"),
        F.col("improved").alias("n_improved"),
        F.col("declined").alias("n_declined"),
        F.col("same").alias("n_no_change"),
        rounded_percent(F.col("improved"), F.col("pairs")).alias("pct_improved"),
        round_half_away(safe_ratio(F.col("days"), F.col("pairs")), 0).alias(
            "avg_days_between_tests"
        ),
        F.col("female").alias("female_count"),
        F.col("pwd").alias("pwd_count"),
        F.col("bpl").alias("bpl_count"),
    ).orderBy(
        F.desc("matched_pairs_count"), F.desc("avg_improvement_pct"), "program_name", "sector"
    )
