"""One registered query per operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import whole
from checks.fixtures import base_table, clean_sample, dirty_sample, raw_sample
from tallygrove import model
from tallygrove.functions import labels, periods
from tallygrove.functions.numbers import (
    count_where,
    percent_of,
    round_half_away,
    rounded_percent,
    safe_ratio,
    sum_money,
    sum_money_when,
    tenths,
)
from tallygrove.functions.text import match_key
from tallygrove.operators import dedup, impute, joins, quality, references, standardise
from tallygrove.operators.audit import summarise
from tallygrove.operators.dimensions import one_dimension_totals
from tallygrove.operators.schema_check import schema_check
from tallygrove.operators.staging import written_stage
from tallygrove.plans import blocks, clean, dashboard, kpis, views
from tallygrove.rules import DEFAULT_RULES
from tallygrove.session import scratch_path
from tallygrove.sources import csv_dir, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def union_all(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# -- sources and sinks -------------------------------------------------------


@query
def src_csv_dir(spark, sf_dir):
    """Every cell of a folder, one table of which has rows that are longer than its header."""
    folder = scratch_path(spark, "src_csv_dir")
    tables = dirty_sample(spark, sf_dir).all()
    sinks.write_csv_tables(tables, folder)
    longer = tables["regions"].filter("region_id % 2 = 0")
    lines = longer.select(F.concat_ws(",", "region_id", "state", "district", F.lit("surplus")).alias("value"))
    header = spark.range(1).select(F.lit("region_id,state,district").alias("value"))
    header.unionAll(lines).coalesce(1).write.text(f"{folder}/longer.csv")
    back = csv_dir.load_csv_tables(spark, folder, rescue=True)

    def cells(name: str) -> DataFrame:
        columns = [c for c in back[name].columns if c != csv_dir.RESCUED]
        pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]
        return back[name].select(
            F.lit(name).alias("table_name"), F.col(columns[0]).alias("record_id"),
            F.col(csv_dir.RESCUED).alias("rescued"), F.inline(F.array(*pairs)),
        )

    return union_all(cells(name) for name in sorted(back))


@query
def sink_csv(spark, sf_dir):
    folder = scratch_path(spark, "sink_csv")
    tables = clean_sample(spark, sf_dir)
    sinks.write_csv_tables({n: tables[n] for n in ("funding", "beneficiaries")}, folder)
    back = csv_dir.load_csv_tables(spark, folder)
    funding = back["funding"].groupBy(F.col("fiscal_year").alias("grp")).agg(
        F.count("*").alias("n_rows"), sum_money(F.col("amount_inr").cast("double")).alias("total")
    )
    people = back["beneficiaries"].groupBy(F.col("income_bracket").alias("grp")).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("household_size").cast("bigint")).cast("double").alias("total"),
    )
    return funding.unionByName(people)


@query
def sink_tables(spark, sf_dir):
    """A set that is published twice; every table of the second is read back."""
    folder = scratch_path(spark, "sink_tables")
    tables = clean_sample(spark, sf_dir)
    names = ("expenses", "funding", "regions", "beneficiaries")
    sinks.publish_tables({"regions": tables["regions"]}, folder)
    sinks.publish_tables({n: tables[n] for n in names}, folder)
    back = sinks.published_tables(spark, folder)
    totals = [(n, "fiscal_year", sum_money(F.col("amount_inr"))) for n in names[:2]]
    totals.append(("regions", "region_type", F.sum("region_id").cast("double")))
    totals.append(("beneficiaries", "gender", F.sum("household_size").cast("double")))
    return union_all(
        back[n].groupBy(F.col(key).alias("grp")).agg(F.count("*").alias("n_rows"), total.alias("total"))
        .select(F.lit(n).alias("table_name"), "grp", "n_rows", "total")
        for n, key, total in totals
    )


def _cleaned(spark, sf_dir) -> clean.CleanResult:
    stage_dir = scratch_path(spark, "clean")
    return clean.clean(dirty_sample(spark, sf_dir).all(), stage_dir=stage_dir)


_AUDIT_COUNTS = ("table_name", "step_no", "step", "rows_before", "rows_after", "rows_affected")


@query
def sink_audit(spark, sf_dir):
    folder = scratch_path(spark, "sink_audit")
    sinks.write_audit(_cleaned(spark, sf_dir).audit, folder)
    back = csv_dir.load_csv_tables(spark, folder)[sinks.AUDIT_NAME]
    numbers = {c: F.col(c).cast("bigint") for c in ("rows_before", "rows_after", "rows_affected")}
    return back.withColumns({"step_no": F.col("step_no").cast("int"), **numbers}).select(
        *_AUDIT_COUNTS, F.coalesce("details", F.lit("")).alias("details")
    )


@query
def view_catalog(spark, sf_dir):
    return views.register_views(spark, clean_sample(spark, sf_dir))


@query
def schema_report(spark, sf_dir):
    tables = dirty_sample(spark, sf_dir)
    return schema_check({n: tables[n] for n in ("beneficiaries", "service_delivery", "assessments")})


QUERIES["schema_check"] = QUERIES.pop("schema_report")


@query
def schema_check_whole(spark, sf_dir):
    return schema_check(raw_sample(spark, sf_dir).all())


@query
def star_keys_whole(spark, sf_dir):
    return joins.repeated_keys(raw_sample(spark, sf_dir).all())


@query
def star_join_whole(spark, sf_dir):
    """Rows and matched dimension rows of every fact, over all declared relationships."""
    tables = raw_sample(spark, sf_dir).all()

    def counted(fact: str) -> DataFrame:
        edges = model.star_edges_of(fact)
        matched = [F.count(f"{e.dimension}_{whole.LABEL[e.dimension]}") for e in edges]
        total = reduce(lambda a, b: a + b, matched)
        joined = joins.star_join(tables, fact)
        return joined.agg(F.lit(fact).alias("fact"), F.count("*").alias("n_rows"), total.alias("n_matched"))

    return union_all(counted(f) for f in dict.fromkeys(e.fact for e in model.STAR_EDGES))


# -- cleaning ----------------------------------------------------------------


@query
def clean_drop_tagged_dups(spark, sf_dir):
    people = dirty_sample(spark, sf_dir)["beneficiaries"]
    return dedup.drop_tagged(people, "beneficiary_id").select(
        "beneficiary_id", "full_name", "phone"
    )


@query
def clean_dedup_keys(spark, sf_dir):
    people = dirty_sample(spark, sf_dir)["beneficiaries"]
    keys = DEFAULT_RULES.match_keys["beneficiaries"]
    return dedup.first_per_key(people, keys, "beneficiary_id").select(
        "beneficiary_id", "full_name", "phone", "region_id"
    )


@query
def clean_dates(spark, sf_dir):
    people = dirty_sample(spark, sf_dir)["beneficiaries"]
    return standardise.normalise_dates(people, "beneficiaries").select(
        "beneficiary_id", "registration_date"
    )


_CATEGORICAL = {
    "beneficiaries": "gender",
    "service_delivery": "status",
    "assessments": "assessment_type",
}


@query
def clean_categoricals(spark, sf_dir):
    tables = dirty_sample(spark, sf_dir)
    return union_all(
        standardise.standardise_categories(tables[t], t).select(
            F.lit(t).alias("table_name"),
            F.col(model.PRIMARY_KEY[t]).alias("record_id"),
            F.col(column).alias("value"),
        )
        for t, column in _CATEGORICAL.items()
    )


@query
def clean_unmapped_report(spark, sf_dir):
    tables = dirty_sample(spark, sf_dir)
    return union_all(
        standardise.unmapped_values(tables[t], t).select(
            F.lit(t).alias("table_name"),
            "column_name",
            "n_unmapped",
            F.array_join("sample", "|").alias("sample"),
        )
        for t in _CATEGORICAL
    )


@query
def clean_outliers(spark, sf_dir):
    tables = dirty_sample(spark, sf_dir)
    people = standardise.null_outliers(tables["beneficiaries"]).select(
        F.col("beneficiary_id").alias("record_id"), "age", "household_size"
    )
    services = standardise.null_outliers(tables["service_delivery"]).select(
        F.col("delivery_id").alias("record_id"), "dosage"
    )
    return people.unionByName(services, allowMissingColumns=True)


@query
def clean_outliers_cross(spark, sf_dir):
    tests = dirty_sample(spark, sf_dir)["assessments"]
    return standardise.null_above_sibling(tests, "score", "max_score").select(
        "assessment_id", standardise.number_of(tests, "score").alias("score")
    )


@query
def impute_median(spark, sf_dir):
    people = standardise.null_outliers(dirty_sample(spark, sf_dir)["beneficiaries"])
    return impute.impute_columns(people, {"age": "median", "household_size": "median"}).select(
        "beneficiary_id", "age", "household_size"
    )


@query
def impute_mode(spark, sf_dir):
    people = dirty_sample(spark, sf_dir)["beneficiaries"]
    return impute.impute_columns(people, {"education_level": "mode", "gender": "mode"}).select(
        "beneficiary_id", "education_level", "gender"
    )


@query
def impute_unknown(spark, sf_dir):
    people = dirty_sample(spark, sf_dir)["beneficiaries"]
    return impute.impute_columns(people, {"gender": "unknown", "education_level": "unknown"}).select(
        "beneficiary_id", "gender", "education_level"
    )


@query
def impute_zero(spark, sf_dir):
    services = dirty_sample(spark, sf_dir)["service_delivery"]
    return impute.impute_columns(services, {"dosage": "zero"}).select("delivery_id", "dosage")


@query
def impute_skip(spark, sf_dir):
    people = dirty_sample(spark, sf_dir)["beneficiaries"]
    edits = impute.fill_edits(people, {"phone": "skip", "registration_date": "skip"})
    kept = [count_where(e.flags["skip"]).alias(e.column) for e in edits]
    names = [F.struct(F.lit(e.column).alias("column_name"), F.col(e.column).alias("n_kept")) for e in edits]
    return people.agg(*kept).select(F.inline(F.array(*names)))


@query
def clean_fk(spark, sf_dir):
    tables = dirty_sample(spark, sf_dir)
    parents = dedup.deduplicate(tables["beneficiaries"], "beneficiaries", "beneficiary_id")
    return references.check_reference(
        tables["service_delivery"], "beneficiary_id", parents, "beneficiary_id", "delivery_id",
        stage=written_stage(scratch_path(spark, "clean_fk")),
    ).select("delivery_id", "beneficiary_id")


@query
def clean_cast(spark, sf_dir):
    people = dirty_sample(spark, sf_dir)["beneficiaries"]
    return standardise.cast_types(people).select(
        "beneficiary_id", "full_name", "age", "gender", "household_size"
    )


@query
def clean_audit(spark, sf_dir):
    return _cleaned(spark, sf_dir).audit


@query
def clean_summary(spark, sf_dir):
    return summarise(_cleaned(spark, sf_dir).audit)


@query
def clean_all_tables(spark, sf_dir):
    tables = _cleaned(spark, sf_dir).tables
    people = tables["beneficiaries"].select(
        F.lit("beneficiaries").alias("table_name"),
        F.col("beneficiary_id").alias("record_id"),
        F.col("region_id").alias("reference"),
        F.col("gender").alias("category"),
        F.col("age").cast("double").alias("number"),
        "full_name",
        "registration_date",
        "education_level",
        "household_size",
    )
    services = tables["service_delivery"].select(
        F.lit("service_delivery").alias("table_name"),
        F.col("delivery_id").alias("record_id"),
        F.col("beneficiary_id").alias("reference"),
        F.col("status").alias("category"),
        F.col("dosage").cast("double").alias("number"),
    )
    tests = tables["assessments"].select(
        F.lit("assessments").alias("table_name"),
        F.col("assessment_id").alias("record_id"),
        F.col("beneficiary_id").alias("reference"),
        F.col("assessment_type").alias("category"),
        F.col("score").alias("number"),
    )
    return people.unionByName(services, True).unionByName(tests, True)


@query
def clean_whole_schema(spark, sf_dir):
    """Every cell of all twelve cleaned tables."""
    stage_dir = scratch_path(spark, "clean_whole_schema")
    tables = clean.clean(raw_sample(spark, sf_dir).all(), stage_dir=stage_dir).tables

    def cells(name: str) -> DataFrame:
        df = tables[name]
        pairs = [
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in df.columns
        ]
        record = F.col(model.PRIMARY_KEY[name]).alias("record_id")
        return df.select(F.lit(name).alias("table_name"), record, F.inline(F.array(*pairs)))

    return union_all(cells(name) for name in model.CLEANING_ORDER)


@query
def clean_audit_whole(spark, sf_dir):
    """The audit of all twelve tables."""
    stage_dir = scratch_path(spark, "clean_audit_whole")
    return clean.clean(raw_sample(spark, sf_dir).all(), stage_dir=stage_dir).audit.select(*_AUDIT_COUNTS)


# -- relational constructs ---------------------------------------------------


@query
def rel_scan_project(spark, sf_dir):
    return clean_sample(spark, sf_dir)["expenses"].select(
        "expense_id",
        F.col("program_id").alias("program"),
        (F.col("amount_inr") / 1000.0).alias("amount_thousands"),
    )


@query
def rel_filter(spark, sf_dir):
    tests = clean_sample(spark, sf_dir)["assessments"]
    return tests.filter(
        F.col("score").isNotNull() & (F.col("max_score") > 0)
        & (F.col("assessment_type") == "Pre-Test")
    ).select("assessment_id", "beneficiary_id", "score")


@query
def rel_between_bucket(spark, sf_dir):
    age = F.col("age")
    return clean_sample(spark, sf_dir)["beneficiaries"].select(
        "beneficiary_id",
        labels.age_cohort(age).alias("age_cohort"),
        labels.life_stage(age).alias("life_stage"),
    )


@query
def rel_like(spark, sf_dir):
    people = clean_sample(spark, sf_dir)["beneficiaries"]
    return people.filter(F.lower("income_bracket").startswith("bpl")).select(
        "beneficiary_id", "income_bracket"
    )


@query
def rel_cte(spark, sf_dir):
    tables = clean_sample(spark, sf_dir)
    spend = blocks.program_spend(tables["expenses"])
    outcomes = blocks.program_outcomes(tables["outcome_tracking"])
    return outcomes.join(spend, ["program_id", "fiscal_year"]).select(
        "program_id", "indicator_id", "fiscal_year", "total_actual", "achievement_pct",
        "total_spend_inr",
    )


@query
def join_inner(spark, sf_dir):
    tables = clean_sample(spark, sf_dir)
    return (
        tables["outcome_tracking"]
        .join(tables["programs"], "program_id")
        .join(tables["impact_indicators"], "indicator_id")
        .select("outcome_id", "program_name", "indicator_name", "actual_value")
    )


@query
def join_left(spark, sf_dir):
    tables = clean_sample(spark, sf_dir)
    sides = joins.measured(
        {
            "programs": tables["programs"].select(F.col("program_id").alias("p"), "program_name"),
            "regions": tables["regions"].withColumnRenamed("region_id", "r"),
        }
    )
    people = joins.join_dimension(tables["beneficiaries"], sides["programs"], "program_id", "p")
    return joins.join_dimension(people, sides["regions"], "region_id", "r").select(
        "beneficiary_id", "program_name", "state", "region_type"
    )


@query
def join_left_multikey(spark, sf_dir):
    tables = clean_sample(spark, sf_dir)
    funded = tables["funding"].groupBy("program_id", "fiscal_year").agg(
        sum_money(F.col("amount_inr")).alias("total_funding_inr")
    )
    return (
        blocks.program_outcomes(tables["outcome_tracking"])
        .join(funded, ["program_id", "fiscal_year"], "left")
        .select("program_id", "fiscal_year", "indicator_id", "total_actual", "total_funding_inr")
    )


@query
def join_left_preagg(spark, sf_dir):
    tables = clean_sample(spark, sf_dir)
    people = tables["beneficiaries"].select("beneficiary_id")
    return people.join(
        blocks.assessments_per_person(tables["assessments"]), "beneficiary_id", "left"
    )


@query
def join_cross(spark, sf_dir):
    tables = clean_sample(spark, sf_dir)
    programs = tables["programs"].select("program_id", "sector")
    return joins.grid(programs, views.fiscal_years(tables), "program_id")


@query
def join_pair_after(spark, sf_dir):
    pairs = blocks.matched_pairs(clean_sample(spark, sf_dir)["assessments"])
    return pairs.select(
        "beneficiary_id",
        "pre_date",
        (F.col("pre_tenths") / 10.0).alias("pre_score_pct"),
        "post_date",
        (F.col("post_tenths") / 10.0).alias("post_score_pct"),
    )


@query
def join_fanout_agg(spark, sf_dir):
    tables = clean_sample(spark, sf_dir)
    services = blocks.services_per_person(tables["service_delivery"])
    n = F.coalesce(F.col("services_received"), F.lit(0).cast("bigint"))
    return tables["beneficiaries"].join(services, "beneficiary_id", "left").select(
        "beneficiary_id",
        n.alias("services_received"),
        F.coalesce("unique_interventions", F.lit(0).cast("bigint")).alias("unique_interventions"),
        (n > 0).cast("int").alias("is_active_beneficiary"),
    )


@query
def agg_sum_group(spark, sf_dir):
    return clean_sample(spark, sf_dir)["expenses"].groupBy("program_id", "fiscal_year").agg(
        sum_money(F.col("amount_inr")).alias("total_spend_inr")
    )


@query
def agg_count(spark, sf_dir):
    return clean_sample(spark, sf_dir)["beneficiaries"].groupBy("income_bracket").agg(
        F.count("*").alias("n_rows"), F.count("age").alias("n_age"), F.count("gender").alias("n_gender")
    )


@query
def agg_count_distinct(spark, sf_dir):
    return clean_sample(spark, sf_dir)["funding"].groupBy("program_id", "fiscal_year").agg(
        F.count_distinct("donor_id").alias("donor_count")
    )


@query
def agg_avg(spark, sf_dir):
    tests = clean_sample(spark, sf_dir)["assessments"]
    held = tests.withColumn("t", tenths(percent_of(F.col("score"), F.col("max_score"))))
    return held.groupBy("assessment_type").agg(
        round_half_away(safe_ratio(F.sum("t"), F.count("t").cast("double") * 10.0), 1).alias(
            "avg_score_pct"
        )
    )


@query
def agg_max_case(spark, sf_dir):
    tests = clean_sample(spark, sf_dir)["assessments"]
    post = F.col("assessment_type") == "Post-Test"
    return tests.groupBy("beneficiary_id").agg(
        F.max(F.when(post, F.col("score"))).alias("best_post_score")
    )


@query
def agg_conditional_sum(spark, sf_dir):
    category, amount = F.col("category"), F.col("amount_inr")
    return clean_sample(spark, sf_dir)["expenses"].groupBy("fiscal_year").agg(
        sum_money_when(category == blocks.PERSONNEL, amount).alias("personnel_inr"),
        sum_money_when(category == blocks.MONITORING, amount).alias("me_inr"),
        count_where(category == blocks.FIELD).alias("n_field"),
    )


@query
def agg_conditional_avg(spark, sf_dir):
    active = F.col("is_disabled") == 1
    return clean_sample(spark, sf_dir)["beneficiaries"].groupBy("gender").agg(
        round_half_away(
            safe_ratio(F.sum(F.when(active, F.col("household_size"))), F.count(F.when(active, F.col("household_size")))),
            1,
        ).alias("avg_household_pwd")
    )


@query
def agg_group_by_expr(spark, sf_dir):
    year = periods.period_fiscal_year(F.col("reporting_period")).alias("fiscal_year")
    return clean_sample(spark, sf_dir)["outcome_tracking"].groupBy(year).agg(
        F.sum("actual_value").alias("total_actual"), F.count("*").alias("n_rows")
    )


@query
def agg_multi_dimension(spark, sf_dir):
    people = clean_sample(spark, sf_dir)["beneficiaries"].withColumn("n", F.lit(1).cast("bigint"))
    dims = {"Gender": "gender", "Income Bracket": "income_bracket", "Disability": "is_disabled"}
    return one_dimension_totals(people, dims, ["n", "household_size"])


@query
def win_lag(spark, sf_dir):
    rows = blocks.quarter_rows(clean_sample(spark, sf_dir))
    return rows.select("outcome_id", "actual_value", "prev_quarter_actual")


@query
def win_running_sum(spark, sf_dir):
    rows = blocks.quarter_rows(clean_sample(spark, sf_dir))
    return rows.select("outcome_id", "cumulative_actual", "cumulative_target")


@query
def win_partition_total(spark, sf_dir):
    per_region = clean_sample(spark, sf_dir)["beneficiaries"].groupBy("region_id", "gender").agg(
        F.count("*").alias("n")
    )
    whole = F.sum("n").over(Window.partitionBy("region_id"))
    return per_region.select("region_id", "gender", "n", rounded_percent(F.col("n"), whole).alias("share"))


@query
def win_dense_rank(spark, sf_dir):
    rows = blocks.cost_rows(clean_sample(spark, sf_dir), many=True)
    return rows.select("program_id", "iris_id", "fiscal_year", "efficiency_rank")


@query
def win_row_number_desc(spark, sf_dir):
    rows = blocks.quarter_rows(clean_sample(spark, sf_dir))
    return rows.select("outcome_id", "recency_rank")


@query
def win_first_last_per_key(spark, sf_dir):
    tests = clean_sample(spark, sf_dir)["assessments"]
    person = Window.partitionBy("beneficiary_id")
    parts = []
    for kind, day in (("Pre-Test", F.asc("assessment_date")), ("Post-Test", F.desc("assessment_date"))):
        ranked = tests.filter(F.col("assessment_type") == kind).withColumn(
            "rn", F.row_number().over(person.orderBy(day, "assessment_id"))
        )
        parts.append(ranked.filter("rn = 1").drop("rn"))
    return union_all(parts).select(
        "beneficiary_id", "assessment_type", "assessment_id", "assessment_date", "score"
    )


@query
def sort_multi(spark, sf_dir):
    return (
        clean_sample(spark, sf_dir)["funding"]
        .select("fiscal_year", "amount_inr", "funding_id")
        .orderBy(F.asc("fiscal_year"), F.desc("amount_inr"), "funding_id")
    )


@query
def set_union_all(spark, sf_dir):
    tables = clean_sample(spark, sf_dir)
    money = F.col("amount_inr")
    return union_all(
        [
            tables["expenses"].select(F.lit("out").alias("flow"), "program_id", "fiscal_year", money),
            tables["funding"].select(F.lit("in").alias("flow"), "program_id", "fiscal_year", money),
        ]
    )


@query
def set_union_distinct(spark, sf_dir):
    return views.fiscal_years(clean_sample(spark, sf_dir))


@query
def set_distinct(spark, sf_dir):
    return clean_sample(spark, sf_dir)["expenses"].select("fiscal_year", "category").distinct()


# -- scalar functions --------------------------------------------------------


@query
def fn_substr(spark, sf_dir):
    period = F.col("reporting_period")
    return clean_sample(spark, sf_dir)["outcome_tracking"].select(
        "outcome_id",
        periods.period_fiscal_year(period).alias("fiscal_year"),
        F.substring(period, 2, 1).alias("quarter_text"),
    )


@query
def fn_cast_int(spark, sf_dir):
    return clean_sample(spark, sf_dir)["outcome_tracking"].select(
        "outcome_id", periods.period_quarter(F.col("reporting_period")).alias("quarter_num")
    )


@query
def fn_round(spark, sf_dir):
    lines = base_table(spark, sf_dir, "lineitem")
    value = F.col("l_extendedprice") * (1.0 - F.col("l_discount")) - 30000.0
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        round_half_away(value, 2).alias("rounded_2"),
        round_half_away(value / 100.0, 1).alias("rounded_1"),
        round_half_away(value / 100.0, 0).alias("rounded_0"),
    )


@query
def fn_safe_ratio(spark, sf_dir):
    lines = base_table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        safe_ratio(F.col("l_quantity"), F.col("l_discount") * 100.0).alias("ratio"),
    )


@query
def fn_coalesce(spark, sf_dir):
    return clean_sample(spark, sf_dir)["beneficiaries"].select(
        "beneficiary_id",
        F.coalesce("gender", F.lit("Unknown")).alias("gender"),
        F.coalesce("age", F.lit(0)).alias("age"),
    )


@query
def fn_days_between(spark, sf_dir):
    pairs = blocks.matched_pairs(clean_sample(spark, sf_dir)["assessments"])
    return pairs.select("beneficiary_id", "days_between_tests")


@query
def fn_rag(spark, sf_dir):
    return clean_sample(spark, sf_dir)["outcome_tracking"].select(
        "outcome_id",
        labels.achievement_light(F.col("actual_value"), F.col("target_value")).alias("rag_status"),
    )


@query
def fn_momentum(spark, sf_dir):
    rows = blocks.quarter_rows(clean_sample(spark, sf_dir))
    return rows.select(
        "outcome_id",
        labels.momentum(F.col("actual_value"), F.col("prev_quarter_actual")).alias("momentum"),
    )


@query
def fn_outcome_direction(spark, sf_dir):
    pairs = blocks.matched_pairs(clean_sample(spark, sf_dir)["assessments"])
    return pairs.select("beneficiary_id", "outcome_direction")


@query
def fn_flag_labels(spark, sf_dir):
    tables = clean_sample(spark, sf_dir)
    flag = F.col("is_disabled")
    people = tables["beneficiaries"].select(
        F.col("beneficiary_id").cast("string").alias("record_id"),
        labels.disability_status(flag).alias("label"),
        labels.pwd_flag(flag).alias("flag"),
    )
    outcomes = tables["outcome_tracking"].select(
        F.col("outcome_id").alias("record_id"),
        labels.verification_status(F.col("verified_by")).alias("label"),
        F.lit(None).cast("string").alias("flag"),
    )
    return people.unionByName(outcomes)


@query
def fn_lower_trim(spark, sf_dir):
    return dirty_sample(spark, sf_dir)["beneficiaries"].select(
        "beneficiary_id",
        match_key(F.col("full_name")).alias("name_key"),
        match_key(F.col("gender")).alias("gender_key"),
    )


@query
def fn_fiscal_year(spark, sf_dir):
    return base_table(spark, sf_dir, "orders").select(
        "o_orderkey", periods.fiscal_year(F.col("o_orderdate")).alias("fiscal_year")
    )


@query
def fn_reporting_period(spark, sf_dir):
    """Order counts over the calendar of all quarters the orders span."""
    orders = base_table(spark, sf_dir, "orders").select(
        periods.reporting_period(F.col("o_orderdate")).alias("reporting_period")
    )
    used = orders.groupBy("reporting_period").agg(F.count("*").alias("n_orders"))
    calendar = periods.quarter_calendar(spark, 1991, 1999)
    return calendar.join(used, "reporting_period", "left").select(
        "reporting_period",
        "fiscal_year",
        "quarter_num",
        F.coalesce("n_orders", F.lit(0).cast("bigint")).alias("n_orders"),
    )


@query
def fn_outcome_status(spark, sf_dir):
    return clean_sample(spark, sf_dir)["outcome_tracking"].select(
        "outcome_id",
        labels.outcome_status(F.col("actual_value"), F.col("target_value")).alias("status"),
    )


@query
def fn_program_status(spark, sf_dir):
    ended = F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate"))
    return base_table(spark, sf_dir, "orders").select(
        "o_orderkey", labels.program_status(ended, dt.date(1995, 1, 1)).alias("status")
    )


# -- KPI reports and views ---------------------------------------------------


@query
def kpi1_cost_per_impact(spark, sf_dir):
    return kpis.cost_per_impact(clean_sample(spark, sf_dir))


@query
def kpi2_programme_progress(spark, sf_dir):
    return kpis.programme_progress(clean_sample(spark, sf_dir))


@query
def kpi3_demographic_reach(spark, sf_dir):
    return kpis.demographic_reach(clean_sample(spark, sf_dir))


@query
def kpi4_outcome_effectiveness(spark, sf_dir):
    return kpis.outcome_effectiveness(clean_sample(spark, sf_dir))


@query
def v_cost_per_impact(spark, sf_dir):
    return views.v_cost_per_impact(clean_sample(spark, sf_dir))


@query
def v_programme_progress(spark, sf_dir):
    return views.v_programme_progress(clean_sample(spark, sf_dir))


@query
def v_beneficiary_360(spark, sf_dir):
    return views.v_beneficiary_360(clean_sample(spark, sf_dir))


@query
def v_outcome_effectiveness(spark, sf_dir):
    return views.v_outcome_effectiveness(clean_sample(spark, sf_dir))


@query
def v_financial_overview(spark, sf_dir):
    return views.v_financial_overview(clean_sample(spark, sf_dir))


# -- dashboard ---------------------------------------------------------------


@query
def dash_filter(spark, sf_dir):
    tables = clean_sample(spark, sf_dir)
    progress = views.v_programme_progress(tables)
    cost = views.v_cost_per_impact(tables)
    latest = dashboard.default_filters(progress, year_source=cost).select(
        F.lit("latest year").alias("filter"), "outcome_id"
    )
    chosen = dashboard.apply_filters(
        progress, fiscal_year="FY1996-97", programs=["Programme Brand#3", "Programme Brand#13"],
        state="EUROPE", sector="Sector 3",
    ).select(F.lit("all four").alias("filter"), "outcome_id")
    sector = dashboard.apply_filters(progress, sector="Sector 3").select(
        F.lit("sector").alias("filter"), "outcome_id"
    )
    return union_all([latest, chosen, sector])


@query
def star_join(spark, sf_dir):
    tables = clean_sample(spark, sf_dir).all()
    return joins.star_join(tables, "beneficiaries").select(
        "beneficiary_id", "programs_program_name", "programs_sector", "programs_status",
        "regions_state", "regions_district", "regions_region_type",
    )


@query
def star_join_inner(spark, sf_dir):
    tables = clean_sample(spark, sf_dir).all()
    return joins.star_join(tables, "service_delivery").select(
        "delivery_id", "delivery_date", "beneficiaries_gender", "beneficiaries_income_bracket"
    )


@query
def star_keys(spark, sf_dir):
    tables = clean_sample(spark, sf_dir)
    names = ("regions", "programs", "impact_indicators", "beneficiaries")
    return joins.repeated_keys({n: tables[n] for n in names})


@query
def dash_card_cost(spark, sf_dir):
    return dashboard.card_cost(views.v_cost_per_impact(clean_sample(spark, sf_dir)))


@query
def dash_card_achievement(spark, sf_dir):
    return dashboard.card_achievement(views.v_programme_progress(clean_sample(spark, sf_dir)))


@query
def dash_card_reach(spark, sf_dir):
    return dashboard.card_reach(views.v_beneficiary_360(clean_sample(spark, sf_dir)))


@query
def dash_card_improved(spark, sf_dir):
    return dashboard.card_improved(views.v_outcome_effectiveness(clean_sample(spark, sf_dir)))


@query
def dash_qoq(spark, sf_dir):
    return dashboard.quarter_growth(views.v_programme_progress(clean_sample(spark, sf_dir)))


@query
def dash_burn_rate(spark, sf_dir):
    return dashboard.burn_rate(views.v_financial_overview(clean_sample(spark, sf_dir)))


@query
def dash_cost_bars(spark, sf_dir):
    return dashboard.cost_bars(views.v_cost_per_impact(clean_sample(spark, sf_dir)))


@query
def dash_trend_top5(spark, sf_dir):
    return dashboard.trend_top(views.v_programme_progress(clean_sample(spark, sf_dir)))


@query
def dash_demographic_share(spark, sf_dir):
    return dashboard.demographic_share(views.v_beneficiary_360(clean_sample(spark, sf_dir)))


@query
def dash_outcome_heatmap(spark, sf_dir):
    return dashboard.outcome_heatmap(views.v_outcome_effectiveness(clean_sample(spark, sf_dir)))


@query
def dash_detail_page(spark, sf_dir):
    people = views.v_beneficiary_360(clean_sample(spark, sf_dir))
    return dashboard.detail_page(people, page=3, search="customer#0")


@query
def dash_activation_distinct(spark, sf_dir):
    return dashboard.activation_distinct(views.v_beneficiary_360(clean_sample(spark, sf_dir)))


# -- issue log ---------------------------------------------------------------


def _row_issues(spark, sf_dir, kind: str) -> DataFrame:
    tables = dirty_sample(spark, sf_dir)
    names = ("beneficiaries", "service_delivery", "assessments")
    return union_all(quality.row_issues(tables[t], t, kinds=(kind,)) for t in names)


@query
def dq_missing(spark, sf_dir):
    return _row_issues(spark, sf_dir, quality.MISSING)


@query
def dq_date_format(spark, sf_dir):
    return _row_issues(spark, sf_dir, quality.DATE_FORMAT)


@query
def dq_casing(spark, sf_dir):
    return _row_issues(spark, sf_dir, quality.CASING)


@query
def dq_outlier(spark, sf_dir):
    return _row_issues(spark, sf_dir, quality.OUTLIER)


@query
def dq_duplicate(spark, sf_dir):
    return quality.duplicate_issues(dirty_sample(spark, sf_dir)["beneficiaries"], "beneficiaries")


@query
def dq_orphan(spark, sf_dir):
    tables = dirty_sample(spark, sf_dir)
    people, keys = tables["beneficiaries"], quality.surviving_keys
    people_keys, region_keys = keys(people, "beneficiaries"), keys(tables["regions"], "regions")
    return union_all(
        (
            quality.orphan_issues(people, "beneficiaries", "region_id", region_keys, "region_id"),
            *(
                quality.orphan_issues(tables[t], t, "beneficiary_id", people_keys, "beneficiary_id")
                for t in ("service_delivery", "assessments")
            ),
        )
    )


@query
def dq_name_variant(spark, sf_dir):
    people = dirty_sample(spark, sf_dir)["beneficiaries"]
    return quality.name_variants(people, "beneficiary_id", "full_name", "region_id")


@query
def dq_log(spark, sf_dir):
    stage = written_stage(scratch_path(spark, "dq_log"))
    return quality.issue_log(dirty_sample(spark, sf_dir).all(), dt.date(2025, 6, 12), stage=stage)


@query
def dq_log_rerun(spark, sf_dir):
    """The log of a second run over changed tables: mended rows, dropped rows, new gaps."""
    first = {n: dirty_sample(spark, sf_dir)[n] for n in ("service_delivery", "assessments")}
    score = F.when(F.col("assessment_id").cast("bigint") % 50 != 1, F.col("score"))
    second = {
        "service_delivery": first["service_delivery"].filter("cast(delivery_id as bigint) % 4 <> 0"),
        "assessments": first["assessments"].withColumn("score", score),
    }
    # Each log is read once, by the merge.
    logs = [quality.issue_log(tables, dt.date(2025, 6, day)) for day, tables in ((12, first), (19, second))]
    return quality.merge_log(*logs)
