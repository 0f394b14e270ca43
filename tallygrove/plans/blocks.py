"""Building blocks shared by the KPI reports and the flat views.

Facts are reduced to their reporting grain before they meet a dimension, so
dimension joins run on aggregated rows whenever the report allows it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.functions import labels
from tallygrove.functions.numbers import (
    exact_sum,
    rounded_percent,
    round_half_away,
    safe_ratio,
    sum_money,
    sum_money_when,
    tenths,
)
from tallygrove.functions.periods import period_fiscal_year, period_quarter
from tallygrove.operators.joins import Side, join_dimension
from tallygrove.operators.ranks import with_dense_rank

Tables = Mapping[str, DataFrame]

PERSONNEL = "Personnel"
MONITORING = "Monitoring & Evaluation"
FIELD = "Travel & Field"
OVERHEAD = "Administrative Overhead"


# -- money and outcomes ------------------------------------------------------


def program_spend(expenses: DataFrame) -> DataFrame:
    """Spend per program and fiscal year, with two categories apart."""
    category, amount = F.col("category"), F.col("amount_inr")
    return expenses.groupBy("program_id", "fiscal_year").agg(
        sum_money(amount).alias("total_spend_inr"),
        sum_money_when(category == PERSONNEL, amount).alias("personnel_spend_inr"),
        sum_money_when(category == MONITORING, amount).alias("me_spend_inr"),
    )


def program_outcomes(outcomes: DataFrame) -> DataFrame:
    """Targets and actuals per program, indicator and fiscal year.

    Only quarters with a positive actual take part, for the target as well.
    """
    return (
        outcomes.filter(F.col("actual_value") > 0)
        .groupBy(
            "program_id",
            "indicator_id",
            period_fiscal_year(F.col("reporting_period")).alias("fiscal_year"),
        )
        .agg(
            exact_sum(F.col("target_value")).alias("total_target"),
            exact_sum(F.col("actual_value")).alias("total_actual"),
        )
        .withColumn(
            "achievement_pct", rounded_percent(F.col("total_actual"), F.col("total_target"))
        )
    )


def cost_rows(tables: Tables, many: bool = False) -> DataFrame:
    """Outcome rows with program, indicator and spend; unit cost and rank added.

    Both facts are aggregated first, so the joins see one row per program,
    indicator and year.  Programs carry their whole spend on every indicator.
    """
    programs = tables["programs"].withColumnRenamed("status", "program_status")
    indicators = tables["impact_indicators"].select(
        "indicator_id",
        "iris_id",
        "indicator_name",
        F.col("unit").alias("indicator_unit"),
        F.col("category").alias("indicator_category"),
    )
    unit_cost = safe_ratio(F.col("total_spend_inr"), F.col("total_actual"))
    rows = (
        program_outcomes(tables["outcome_tracking"])
        .join(program_spend(tables["expenses"]), ["program_id", "fiscal_year"])
        .filter("total_spend_inr is not null")
        .join(programs, "program_id")
        .join(indicators, "indicator_id")
        .withColumn("__unit_cost", unit_cost)
        .withColumns(
            {
                "cost_per_unit_inr": round_half_away(F.col("__unit_cost"), 2),
                "personnel_pct": rounded_percent(
                    F.col("personnel_spend_inr"), F.col("total_spend_inr")
                ),
                "me_investment_pct": rounded_percent(
                    F.col("me_spend_inr"), F.col("total_spend_inr")
                ),
            }
        )
    )
    if many:
        return with_dense_rank(rows, "iris_id", "__unit_cost", "efficiency_rank")
    per_indicator = Window.partitionBy("iris_id").orderBy("__unit_cost")
    return rows.withColumn("efficiency_rank", F.dense_rank().over(per_indicator))


def quarter_rows(tables: Tables) -> DataFrame:
    """Reported quarters with program, indicator, trend and recency.

    A window group is one program and indicator; by the grain of the table it
    holds one row per quarter.  The outcome id settles ties.  The windows come
    before the joins: those keep or drop whole groups, so the result is the
    same, and only the columns of the fact are shuffled for the windows.
    """
    pair = Window.partitionBy("program_id", "indicator_id")
    forward = pair.orderBy("fiscal_year", "quarter_num", "outcome_id")
    upto = forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    period = F.col("reporting_period")
    actual, target = F.col("actual_value"), F.col("target_value")
    trends = (
        tables["outcome_tracking"]
        .filter("actual_value is not null and program_id is not null and indicator_id is not null")
        .withColumns(
            {"quarter_num": period_quarter(period), "fiscal_year": period_fiscal_year(period)}
        )
        .select(
            "outcome_id", "program_id", "indicator_id", "reporting_period", "quarter_num",
            "fiscal_year", "target_value", "actual_value", "data_source", "verified_by",
        )
        .withColumns(
            {
                "prev_quarter_actual": F.lag("actual_value").over(forward),
                "cumulative_actual": F.sum("actual_value").over(upto),
                "cumulative_target": F.sum("target_value").over(upto),
                # The forward order read backwards, so that one sort serves all.
                "recency_rank": (
                    F.count("*").over(pair) - F.row_number().over(forward) + 1
                ).cast("int"),
            }
        )
    )
    programs = tables["programs"].select(
        F.col("program_id").alias("__program"),
        "program_name",
        "sector",
        "region_id",
        F.col("status").alias("program_status"),
    )
    indicators = tables["impact_indicators"].select(
        F.col("indicator_id").alias("__indicator"),
        "iris_id",
        "indicator_name",
        F.col("category").alias("indicator_category"),
    )
    with_program = join_dimension(
        trends, Side(programs, small=False), "program_id", "__program", "inner"
    )
    return (
        join_dimension(
            with_program, Side(indicators, small=False), "indicator_id", "__indicator", "inner"
        )
        .drop("__program", "__indicator")
        .withColumns(
            {
                "achievement_pct": rounded_percent(actual, target),
                "rag_status": labels.achievement_light(actual, target),
                "verification_status": labels.verification_status(F.col("verified_by")),
            }
        )
    )


# -- people ------------------------------------------------------------------


def services_per_person(deliveries: DataFrame) -> DataFrame:
    """Services and distinct interventions per person.

    The distinct count goes by (person, intervention) first, so one busy
    person is spread over tasks.  Rows without a person match nobody.
    """
    return (
        deliveries.filter("beneficiary_id is not null")
        .groupBy("beneficiary_id", "intervention_id")
        .agg(F.count("delivery_id").alias("n"))
        .groupBy("beneficiary_id")
        .agg(
            F.sum("n").alias("services_received"),
            F.count("intervention_id").alias("unique_interventions"),
        )
    )


def assessments_per_person(assessments: DataFrame) -> DataFrame:
    """Assessments and best score per person."""
    score, limit = F.col("score"), F.col("max_score")
    percent = F.when(score.isNotNull() & (limit > 0), score * 100.0 / limit)
    return (
        assessments.filter("beneficiary_id is not null")
        .groupBy("beneficiary_id")
        .agg(
            F.count("assessment_id").alias("assessments_taken"),
            F.max(percent).alias("best"),
        )
        .select(
            "beneficiary_id",
            "assessments_taken",
            round_half_away(F.col("best"), 1).alias("latest_score_pct"),
        )
    )


# Sorts a test without a date behind all others.
_NO_DAY = 2**31 - 1


def matched_pairs(assessments: DataFrame) -> DataFrame:
    """Earliest Pre-Test and latest Post-Test of each person, if in that order.

    One aggregate finds both tests: the least struct led by the date, or by
    the negated date, with the assessment id settling ties.  It combines on
    the map side, so a person with very many tests costs one row per task.
    Scores are held in tenths of a percent.  Tests of nobody make no pair.
    """
    kind, day = F.col("assessment_type"), F.col("assessment_date").cast("date")
    tests = (
        assessments.filter(
            F.col("beneficiary_id").isNotNull()
            & kind.isin("Pre-Test", "Post-Test")
            & F.col("score").isNotNull()
            & (F.col("max_score") > 0)
        )
        .select(
            "beneficiary_id",
            "assessment_id",
            kind.alias("kind"),
            F.unix_date(day).alias("day"),
            tenths(F.col("score") * 100.0 / F.col("max_score")).alias("tenths"),
        )
    )

    def pick(of_kind: str, order: Column) -> Column:
        test = F.struct(order.alias("order"), "assessment_id", "day", "tenths")
        return F.min(F.when(F.col("kind") == of_kind, test))

    picked = tests.groupBy("beneficiary_id").agg(
        pick("Pre-Test", F.col("day")).alias("pre"),
        pick("Post-Test", F.coalesce(-F.col("day"), F.lit(_NO_DAY))).alias("post"),
    )
    before, after = F.col("pre.tenths"), F.col("post.tenths")
    return picked.filter(F.col("post.day") > F.col("pre.day")).select(
        "beneficiary_id",
        F.date_from_unix_date("pre.day").alias("pre_date"),
        before.alias("pre_tenths"),
        F.date_from_unix_date("post.day").alias("post_date"),
        after.alias("post_tenths"),
        (after - before).alias("gain_tenths"),
        tenths(safe_ratio((after - before) * 100.0, before)).alias("effect_tenths"),
        (F.col("post.day") - F.col("pre.day")).alias("days_between_tests"),
        labels.outcome_direction(before, after).alias("outcome_direction"),
    )
