"""Data behind the dashboard: filters, cards, charts and the detail page.

Every function takes one of the flat views (filtered or not).  Windows
without a partition run on rows per fiscal year or per quarter only.

Fixed values: thresholds, class names and output columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.functions import labels
from tallygrove.functions.numbers import (
    count_where,
    hundredths,
    mean_of_tenths,
    percent_of,
    round_half_away,
    rounded_percent,
    safe_ratio,
    sum_money,
    tenths,
)
from tallygrove.operators.dimensions import one_dimension_totals
from tallygrove.operators.joins import grid
from tallygrove.plans import views
from tallygrove.plans.blocks import Tables

LATEST = "latest"
TOP_PROGRAMS = 5
PAGE_ROWS = 20


def apply_filters(
    view: DataFrame,
    fiscal_year: str | None = None,
    programs: Sequence[str] | None = None,
    state: str | None = None,
    sector: str | None = None,
    year_source: DataFrame | None = None,
) -> DataFrame:
    """AND-ed filters; one that the view has no column for is skipped.

    ``fiscal_year=LATEST`` takes the greatest year of ``year_source`` (by
    default the view itself) through a scalar subquery.
    """
    columns = set(view.columns)
    df = view
    if fiscal_year is not None and "fiscal_year" in columns:
        wanted: Column = F.lit(fiscal_year)
        if fiscal_year == LATEST:
            source = view if year_source is None else year_source
            wanted = source.agg(F.max("fiscal_year").alias("latest")).scalar()
        df = df.filter(F.col("fiscal_year") == wanted)
    if programs and "program_name" in columns:
        df = df.filter(F.col("program_name").isin(list(programs)))
    if state is not None and "state" in columns:
        df = df.filter(F.col("state") == state)
    if sector is not None and "sector" in columns:
        df = df.filter(F.col("sector") == sector)
    return df


def default_filters(view: DataFrame, year_source: DataFrame) -> DataFrame:
    """The state of the filter bar on opening: latest year, all else open."""
    return apply_filters(view, fiscal_year=LATEST, year_source=year_source)


# -- cards -------------------------------------------------------------------


def card_cost(cost: DataFrame) -> DataFrame:
    """Cost per impact by fiscal year, with the change against the year before."""
    by_year = cost.groupBy("fiscal_year").agg(
        safe_ratio(sum_money(F.col("total_spend_inr")), F.sum("total_actual")).alias("unit_cost")
    )
    prior = F.lag("unit_cost").over(Window.orderBy("fiscal_year"))
    unit_cost = F.col("unit_cost")
    return by_year.withColumn("prior", prior).select(
        "fiscal_year",
        round_half_away(unit_cost, 2).alias("cost_per_impact"),
        rounded_percent(unit_cost - F.col("prior"), F.col("prior")).alias("change_pct"),
        labels.traffic_light_low(unit_cost, 200, 500).alias("rag_status"),
    )


def _by_quarter(progress: DataFrame) -> DataFrame:
    return progress.groupBy("fiscal_year", "quarter_num", "reporting_period").agg(
        F.sum("actual_value").alias("total_actual"),
        F.sum("target_value").alias("total_target"),
    )


def _in_time():
    return Window.orderBy("fiscal_year", "quarter_num")


def card_achievement(progress: DataFrame) -> DataFrame:
    """Achievement by quarter, with the difference to the quarter before."""
    share = F.coalesce(percent_of(F.col("total_actual"), F.col("total_target")), F.lit(0.0))
    quarters = _by_quarter(progress).withColumn("share", share)
    return quarters.withColumn("prior", F.lag("share").over(_in_time())).select(
        "fiscal_year",
        "reporting_period",
        round_half_away(F.col("share"), 1).alias("achievement_pct"),
        round_half_away(F.col("share") - F.col("prior"), 1).alias("change_pp"),
        labels.traffic_light(F.col("share"), 90, 70).alias("rag_status"),
    )


def card_reach(people: DataFrame) -> DataFrame:
    """People reached, people registered and the share between them."""
    active = F.col("beneficiary_status") == "Active"
    totals = people.agg(count_where(active).alias("reached"), F.count("*").alias("registered"))
    share = F.coalesce(percent_of(F.col("reached"), F.col("registered")), F.lit(0.0))
    return totals.select(
        "reached",
        "registered",
        round_half_away(share, 1).alias("activation_pct"),
        labels.traffic_light(share, 80, 60).alias("rag_status"),
    )


def card_improved(pairs: DataFrame) -> DataFrame:
    """Share of people who improved and their mean gain."""
    improved = F.col("outcome_direction") == "Improved"
    totals = pairs.agg(
        count_where(improved).alias("improved"),
        F.count("*").alias("n_pairs"),
        mean_of_tenths(tenths(F.col("improvement_pct"))).alias("avg_improvement_pp"),
    )
    share = F.coalesce(percent_of(F.col("improved"), F.col("n_pairs")), F.lit(0.0))
    return totals.select(
        round_half_away(share, 1).alias("pct_improved"),
        "n_pairs",
        "avg_improvement_pp",
        labels.traffic_light(share, 70, 50).alias("rag_status"),
    )


def quarter_growth(progress: DataFrame) -> DataFrame:
    """Portfolio growth from quarter to quarter."""
    actual, prior = F.col("total_actual"), F.col("prior")
    return (
        _by_quarter(progress)
        .withColumn("prior", F.lag("total_actual").over(_in_time()))
        .select(
            "fiscal_year",
            "reporting_period",
            "total_actual",
            prior.alias("prior_actual"),
            rounded_percent(actual - prior, prior).alias("qoq_growth_pct"),
        )
    )


def burn_rate(finance: DataFrame) -> DataFrame:
    """Spend as a share of funding over all rows; 0 without funding."""
    totals = finance.agg(
        sum_money(F.col("total_expense_inr")).alias("spent"),
        sum_money(F.col("total_funding_inr")).alias("funded"),
    )
    share = F.coalesce(rounded_percent(F.col("spent"), F.col("funded")), F.lit(0.0))
    return totals.select(
        F.col("spent").alias("total_expense_inr"),
        F.col("funded").alias("total_funding_inr"),
        share.alias("burn_rate_pct"),
    )


# -- charts ------------------------------------------------------------------


def cost_bars(cost: DataFrame) -> DataFrame:
    """Unit cost by program, cheapest first, beside that of the portfolio."""
    by_program = cost.groupBy("program_name", "sector").agg(
        sum_money(F.col("total_spend_inr")).alias("total_spend_inr"),
        F.sum("total_actual").alias("total_actual"),
        F.sum("total_target").alias("total_target"),
    )
    spend, actual = F.col("total_spend_inr"), F.col("total_actual")
    # One row; its condition uses all that the sums hold, so that both uses share one shuffle.
    total = by_program.agg(
        (F.sum(hundredths(spend)) / 100.0).alias("all_spend"),
        F.sum("total_actual").alias("all_actual"),
        F.count_if(F.hash("program_name", "sector", "total_target") == 0).alias("n"),
    ).filter("n >= 0")
    portfolio = round_half_away(safe_ratio(F.col("all_spend"), F.col("all_actual")), 2)
    return grid(by_program, total, "program_name").select(
        "program_name",
        "sector",
        "total_spend_inr",
        "total_actual",
        rounded_percent(actual, F.col("total_target")).alias("achievement_pct"),
        round_half_away(safe_ratio(spend, actual), 2).alias("cost_per_unit_inr"),
        portfolio.alias("portfolio_cost_inr"),
    ).orderBy("cost_per_unit_inr", "program_name")


def trend_top(progress: DataFrame, top: int = TOP_PROGRAMS) -> DataFrame:
    """Achievement by quarter for the largest programs, the rest as 'Other'.

    Rows are summed by program and quarter first.  Ties in the actual total go
    to the lower target, then to the name.  The lookup holds ``top`` rows, so
    it is broadcast whatever the size of the data; as it uses all that the
    sums hold, both uses of them share one shuffle.
    """
    quarters = progress.groupBy(
        "program_name", "fiscal_year", "quarter_num", "reporting_period"
    ).agg(F.sum("actual_value").alias("actual"), F.sum("target_value").alias("target"))
    largest = (
        quarters.groupBy("program_name")
        .agg(F.sum("actual").alias("all_actual"), F.sum("target").alias("all_target"))
        .orderBy(F.desc("all_actual"), "all_target", "program_name")
        .limit(top)
        .select("program_name", F.col("program_name").alias("top_name"))
    )
    # A line holds one row per quarter.
    in_line = Window.partitionBy("line").orderBy("fiscal_year", "quarter_num")
    previous = F.lag("total_actual").over(in_line)
    return (
        quarters.join(F.broadcast(largest), "program_name", "left")
        .groupBy(
            F.coalesce("top_name", F.lit("Other")).alias("line"),
            "fiscal_year",
            "quarter_num",
            "reporting_period",
        )
        .agg(F.sum("actual").alias("total_actual"), F.sum("target").alias("total_target"))
        .select(
            "line",
            "fiscal_year",
            "quarter_num",
            "reporting_period",
            "total_actual",
            "total_target",
            rounded_percent(F.col("total_actual"), F.col("total_target")).alias("achievement_pct"),
            labels.achievement_light(F.col("total_actual"), F.col("total_target")).alias(
                "rag_status"
            ),
            rounded_percent(F.col("total_actual") - previous, previous).alias("qoq_growth_pct"),
            labels.momentum(F.col("total_actual"), previous).alias("momentum"),
        )
    )


SHARE_DIMENSIONS = {
    "gender": "gender",
    "income_bracket": "income_bracket",
    "region_type": "region_type",
    "disability_status": "disability_status",
}


def demographic_share(people: DataFrame) -> DataFrame:
    """Count, share and activation of every segment of four dimensions."""
    active = (F.col("beneficiary_status") == "Active").cast("bigint")
    marked = people.withColumns({"n": F.lit(1).cast("bigint"), "active": active})
    totals = one_dimension_totals(marked, SHARE_DIMENSIONS, ["n", "active"])
    whole = F.sum("n").over(Window.partitionBy("dimension"))
    return totals.select(
        "dimension",
        F.coalesce("raw_value", F.lit("Unknown")).alias("dimension_value"),
        F.col("n").alias("total_count"),
        rounded_percent(F.col("n"), whole).alias("pct_of_total"),
        rounded_percent(F.col("active"), F.col("n")).alias("activation_rate_pct"),
    )


def outcome_heatmap(pairs: DataFrame) -> DataFrame:
    """Pre/post results by program with the colour class of gain and share."""
    improved = F.col("outcome_direction") == "Improved"
    totals = pairs.groupBy("program_name", "sector").agg(
        F.count("*").alias("matched_pairs"),
        mean_of_tenths(tenths(F.col("pre_score_pct"))).alias("baseline_score"),
        mean_of_tenths(tenths(F.col("post_score_pct"))).alias("endline_score"),
        mean_of_tenths(tenths(F.col("improvement_pct"))).alias("improvement_pp"),
        rounded_percent(count_where(improved), F.count("*")).alias("pct_improved"),
        round_half_away(safe_ratio(F.sum("days_between_tests"), F.count("*")), 0).alias(
            "avg_days"
        ),
    )
    gain, share = F.col("improvement_pp"), F.col("pct_improved")
    return totals.withColumns(
        {
            "improvement_class": F.when(gain > 10, "Green").when(gain > 0, "Yellow").otherwise("Red"),
            "improved_class": F.when(share > 70, "Green").when(share >= 50, "Amber").otherwise("Red"),
        }
    ).orderBy(F.desc("improvement_pp"), "program_name")


# -- detail page -------------------------------------------------------------

DETAIL_COLUMNS = (
    "beneficiary_id", "full_name", "age_cohort", "gender", "income_bracket", "region_type",
    "program_name", "sector", "services_received", "beneficiary_status",
)


def detail_page(
    people: DataFrame,
    page: int = 1,
    search: str | None = None,
    after: tuple[int, object] | None = None,
    rows: int = PAGE_ROWS,
) -> DataFrame:
    """One page of people, most services first, then by id.

    Each task keeps only the rows up to the page (top-k), so nothing is sorted
    globally.  For pages far back give ``after``, the services and id of the
    last row seen: the page is then the first of what follows.
    """
    df = people.select(*DETAIL_COLUMNS)
    if search:
        df = df.filter(F.lower("full_name").contains(search.lower()))
    if after is not None:
        services, last_id = after
        df = df.filter(
            (F.col("services_received") < services)
            | ((F.col("services_received") == services) & (F.col("beneficiary_id") > F.lit(last_id)))
        )
    return (
        df.orderBy(F.desc("services_received"), "beneficiary_id").offset((page - 1) * rows).limit(rows)
    )


def activation_distinct(people: DataFrame) -> DataFrame:
    """Distinct active people over distinct people.

    People are reduced to one row each first; two distinct counts in one
    aggregate would copy every row.
    """
    active = F.col("beneficiary_status") == "Active"
    ids = (
        people.filter("beneficiary_id is not null")
        .groupBy("beneficiary_id")
        .agg(F.max(active).alias("active"))
    )
    return ids.agg(
        count_where(F.col("active")).alias("active_people"), F.count("*").alias("people")
    ).select(
        "active_people",
        "people",
        safe_ratio(F.col("active_people"), F.col("people")).alias("activation"),
    )


# -- all of it ---------------------------------------------------------------


def datasets(
    tables: Tables,
    fiscal_year: str | None = LATEST,
    programs: Sequence[str] | None = None,
    state: str | None = None,
    sector: str | None = None,
) -> dict[str, DataFrame]:
    """Every card, chart and table of the dashboard under one set of filters.

    Cards that compare with the period before are computed over all years and
    then cut to the chosen one; otherwise the first period would have nothing
    to compare with.
    """
    flat = views.build_views(tables)
    years = flat["v_cost_per_impact"]

    def chosen_year(df: DataFrame) -> DataFrame:
        return apply_filters(df, fiscal_year=fiscal_year, year_source=years)

    everywhere = {
        name: apply_filters(df, programs=programs, state=state, sector=sector)
        for name, df in flat.items()
    }
    cost, progress = everywhere["v_cost_per_impact"], everywhere["v_programme_progress"]
    people, pairs = everywhere["v_beneficiary_360"], everywhere["v_outcome_effectiveness"]
    return {
        "card_cost": chosen_year(card_cost(cost)),
        "card_achievement": chosen_year(card_achievement(progress)),
        "card_reach": card_reach(people),
        "card_improved": card_improved(pairs),
        "quarter_growth": chosen_year(quarter_growth(progress)),
        "burn_rate": burn_rate(chosen_year(everywhere["v_financial_overview"])),
        "cost_bars": cost_bars(chosen_year(cost)),
        "trend_top": trend_top(chosen_year(progress)),
        "demographic_share": demographic_share(people),
        "outcome_heatmap": outcome_heatmap(pairs),
        "detail_page": detail_page(people),
        "activation_distinct": activation_distinct(people),
    }
