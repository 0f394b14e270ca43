"""A small organisation from raw CSV files to reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallygrove import model
from tallygrove.plans import dashboard, kpis, views
from tallygrove.plans.clean import clean
from tallygrove.sources import csv_dir, sinks

FILES = {
    "regions": """region_id,state,district,block,region_type,latitude,longitude
R1,Bihar,Gaya,,Rural,24.7,85.0
R2,Kerala,Idukki,B2,Tribal,,
""",
    "donors": """donor_id,donor_name,donor_type,country,contact_email,onboarded_date
D1,Hope Trust,Foundation,India,,05-Jan-21
D2,Seva,Corporate,India,a@b.org,2021/02/03
""",
    "impact_indicators": """indicator_id,iris_id,indicator_name,category,unit,sector
I1,PI1,Trained,Output,People,Education
I2,PI2,Employed,Outcome,People,Education
""",
    "programs": """program_id,program_name,sector,start_date,end_date,target_beneficiaries,region_id,status
P1,Pragati,Education,01/04/2022,,100.0,R1,Active
P2,Arogya,Health,01/04/2022,31/03/2024,50,R9,Completed
""",
    "staff": """staff_id,full_name,role,region_id,hire_date,phone,email,is_active
S1,Asha,Lead,R1,03.04.2020,,,1
S2, asha,Lead,R1,03.04.2020,,,1
""",
    "funding": """funding_id,donor_id,program_id,amount_inr,currency,disbursement_date,fiscal_year,grant_type
F1,D1,P1,1000.50,INR,01/05/2023,FY2023-24,
F2,D2,P1,500,INR,02/05/2023,FY2023-24,CSR
F3,D9,P2,300,INR,03/05/2022,FY2022-23,CSR
""",
    "interventions": """intervention_id,program_id,intervention_type,title,scheduled_date,actual_date,staff_id,region_id,planned_attendance,actual_attendance
V1,P1,Camp,"Camp, one",01/06/2023,02/06/2023,S1,R1,30,9999
V2,P1,Class,Class,01/07/2023,,S2,R1,20,18
""",
    "beneficiaries": """beneficiary_id,full_name,age,gender,phone,education_level,income_bracket,region_id,registration_date,program_id,household_size,is_disabled
B1,Meena,34.0,female,1,Primary,BPL (Below 1 lakh),R1,05/06/2023,P1,4,1
B2,Ravi,999,M,2,,LIG,R1,06-25-2023,P1,,0
B3,Kiran,12,nb,3,Primary,LIG,R2,2023-06-07,P2,30,
B1-DUP,Meena,34,female,1,Primary,LIG,R1,05/06/2023,P1,4,1
""",
    "service_delivery": """delivery_id,beneficiary_id,intervention_id,delivery_date,status,dosage,notes
L1,B1,V1,01/06/2023,C,2,ok
L2,B1,V2,02/06/2023,completed,,
L3,B1-DUP,V1,03/06/2023,n,99,
L4,B2,V7,04/06/2023,Scheduled,4,
""",
    "assessments": """assessment_id,beneficiary_id,intervention_id,assessment_type,assessment_date,score,max_score,assessor_staff_id,remarks
A1,B1,V1,pre test,01/06/2023,20,50,S1,
A2,B1,V1,Posttest,01/07/2023,40,50,S1,
A3,B2,V1,PRE-TEST,01/06/2023,30,50,S1,
A4,B2,V1,post-test,11/06/2023,60,50,S1,
""",
    "outcome_tracking": """outcome_id,program_id,indicator_id,reporting_period,target_value,actual_value,status,data_source,verified_by
O1,P1,I1,Q1-FY2023-24,10,8,at risk,Survey,S1
O2,P1,I1,Q2-FY2023-24,10,12,Exceeded,Survey,S9
O3,P1,I2,Q1-FY2023-24,5,,On Track,Survey,
""",
    "expenses": """expense_id,program_id,category,amount_inr,expense_date,fiscal_year,approved_by,receipt_available
E1,P1,Personnel,600.25,01/06/2023,FY2023-24,S1,1
E2,P1,Travel & Field,399.75,02/06/2023,FY2023-24,,0
E3,P2,Personnel,5,02/06/2022,FY2022-23,S1,1
""",
    "data_quality_log": """log_id,table_name
DQL-001,beneficiaries
""",
}


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
    raw = csv_dir.load_csv_tables(spark, str(folder))
    return clean(raw, stage_dir=str(tmp_path_factory.mktemp("stage")))


def test_types(result):
    for name, df in result.tables.items():
        if name != model.PASS_THROUGH:
            want = {f.name: f.dataType for f in model.clean_schema(name)}
            assert {f.name: f.dataType for f in df.schema} == want, name


def test_people(result):
    rows = {r.beneficiary_id: r for r in result.tables["beneficiaries"].collect()}
    assert set(rows) == {"B1", "B2", "B3"}
    assert [rows[b].age for b in ("B1", "B2", "B3")] == [34, 23, 12]
    assert [rows[b].gender for b in ("B1", "B2", "B3")] == ["Female", "Male", "Non-Binary"]
    assert [rows[b].household_size for b in ("B1", "B2", "B3")] == [4, 4, 4]
    assert [rows[b].is_disabled for b in ("B1", "B2", "B3")] == [1, 0, 0]
    assert rows["B2"].education_level == "Unknown"
    assert rows["B2"].registration_date == dt.date(2023, 6, 25)


def test_references(result):
    tables = result.tables
    assert {r.program_id: r.region_id for r in tables["programs"].collect()} == {"P1": "R1", "P2": None}
    # S2 repeats S1 and is gone, so what it led loses its reference.
    assert {r.intervention_id: r.staff_id for r in tables["interventions"].collect()} == {"V1": "S1", "V2": None}
    services = {r.delivery_id: (r.beneficiary_id, r.intervention_id, r.status, r.dosage) for r in tables["service_delivery"].collect()}
    assert services["L3"] == (None, "V1", "No-Show", 3)
    assert services["L4"] == ("B2", None, "Scheduled", 4)
    assert tables["funding"].filter("donor_id is null").count() == 1


def test_audit_covers_every_step(result):
    steps = result.audit.groupBy("table_name").agg(F.count("*").alias("n")).collect()
    want = {t: 6 + len(model.references_of(t)) for t in model.CLEANING_ORDER}
    assert {r.table_name: r.n for r in steps} == want


def test_reports(result):
    tables = result.tables
    (cost,) = kpis.cost_per_impact(tables).collect()
    assert (cost.total_actual, cost.total_spend_inr, cost.cost_per_unit_inr) == (20.0, 1000.0, 50.0)
    assert (cost.achievement_pct, cost.personnel_pct, cost.efficiency_rank) == (100.0, 60.0, 1)
    first, second = kpis.programme_progress(tables).collect()
    assert (first.rag_status, first.momentum, first.recency_rank) == ("AMBER", "N/A (First Quarter)", 2)
    assert (second.qoq_growth_pct, second.cumulative_achievement_pct) == (50.0, 100.0)
    assert (first.verification_status, second.verification_status) == ("Verified", "Unverified")
    reach = {(r.dimension, r.dimension_value): r for r in kpis.demographic_reach(tables).collect()}
    assert reach["Gender", "Female"].avg_services_per_active == 2.0
    assert reach["Region Type", "Rural"].total_active == 2
    assert reach["Program Sector", "Health"].activation_rate_pct == 0.0
    (effect,) = kpis.outcome_effectiveness(tables).collect()
    # The second pair is void: its post-test score is above the maximum.
    assert (effect.matched_pairs_count, effect.avg_improvement_pct, effect.avg_effect_size_pct) == (1, 40.0, 100.0)
    assert (effect.female_count, effect.pwd_count, effect.bpl_count) == (1, 1, 1)


def test_money_by_year(result):
    rows = {(r.program_id, r.fiscal_year): r for r in views.v_financial_overview(result.tables).collect()}
    assert len(rows) == 4
    row = rows["P1", "FY2023-24"]
    assert (row.total_funding_inr, row.donor_count, row.total_expense_inr) == (1500.5, 2, 1000.0)
    assert (row.net_balance_inr, row.burn_rate_pct) == (500.5, 66.6)
    # Five rupees are out of range and count as nothing.
    assert rows["P2", "FY2022-23"].total_expense_inr == 0.0


def test_dashboard_and_sinks(spark, result, tmp_path):
    card = dashboard.datasets(result.tables)["card_cost"].first()
    assert (card.fiscal_year, card.cost_per_impact, card.rag_status) == ("FY2023-24", 50.0, "GREEN")
    sinks.write_csv_tables(result.tables, str(tmp_path / "csv"))
    sinks.write_audit(result.audit, str(tmp_path / "csv"))
    back = csv_dir.load_csv_tables(spark, str(tmp_path / "csv"))
    assert set(back) == set(FILES) | {sinks.AUDIT_NAME}
    assert back["beneficiaries"].filter("registration_date = '2023-06-05'").count() == 1
    sinks.write_tables(result.tables, str(tmp_path / "tables"))
    for name, df in result.tables.items():
        assert spark.read.parquet(str(tmp_path / "tables" / name)).count() == df.count()


def test_csv_with_line_breaks_comes_back(spark, tmp_path):
    rows = [("S1", "two\nlines, one \"cell\""), ("S2", None), ("S3", " blanks ")]
    table = spark.createDataFrame(rows, "delivery_id string, remarks string")
    sinks.write_csv_tables({"service_delivery": table}, str(tmp_path))
    back = csv_dir.load_csv_tables(spark, str(tmp_path))["service_delivery"].collect()
    assert sorted((r.delivery_id, r.remarks) for r in back) == rows


def test_first_of_a_duplicate_group_by_place_in_the_file(spark, tmp_path):
    lines = ["staff_id,full_name,phone", "S9,Ana,1", "S10,Ana,1", "S8,Ana,1"]
    (tmp_path / "staff.csv").write_text("\n".join(lines) + "\n")
    raw = csv_dir.load_csv_tables(spark, str(tmp_path), arrival=True)
    by_place = clean(raw, arrival=csv_dir.ARRIVAL).tables["staff"]
    assert [r.staff_id for r in by_place.collect()] == ["S9"]
    assert by_place.columns == ["staff_id", "full_name", "phone"]
    plain = clean(csv_dir.load_csv_tables(spark, str(tmp_path))).tables["staff"]
    assert [r.staff_id for r in plain.collect()] == ["S10"]


def test_only_the_top_level_is_loaded(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("donors.csv", "sub/old.csv"):
        (tmp_path / name).write_text("donor_id\nD1\n")
    assert list(csv_dir.load_csv_tables(spark, str(tmp_path))) == ["donors"]
    with pytest.raises(FileNotFoundError):
        csv_dir.load_csv_tables(spark, str(tmp_path / "none"))


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from tallygrove.session import scratch_path

    def session(**settings):
        get = lambda key, default=None: settings.get(key, default)
        conf = SimpleNamespace(get=get)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf))

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_path(session(**{"spark.master": "spark://host:7077"}), "x")
    shared = {"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://shared/"}
    assert scratch_path(session(**shared), "x").startswith("hdfs://shared/tallygrove/x-")
    assert scratch_path(session(**{"spark.master": "local[2]"}), "x")
