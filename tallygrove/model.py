"""The thirteen tables: columns, types, keys and references.

Fixed values: table and column names, declared types and NOT NULL marks,
primary keys, references and cleaning order are part of the data contract.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "date": DateType(),
    "decimal(15,2)": DecimalType(15, 2),
}

# Column, type and "not null" where declared.
CLEAN_COLUMNS: dict[str, str] = {
    "regions": """
        region_id string not null, state string not null, district string not null,
        block string, region_type string not null, latitude double, longitude double""",
    "donors": """
        donor_id string not null, donor_name string not null, donor_type string not null,
        country string not null, contact_email string, onboarded_date date""",
    "programs": """
        program_id string not null, program_name string not null, sector string not null,
        start_date date not null, end_date date, target_beneficiaries int,
        region_id string, status string not null""",
    "staff": """
        staff_id string not null, full_name string not null, role string not null,
        region_id string, hire_date date, phone string, email string,
        is_active int not null""",
    "impact_indicators": """
        indicator_id string not null, iris_id string not null,
        indicator_name string not null, category string not null,
        unit string not null, sector string not null""",
    "funding": """
        funding_id string not null, donor_id string not null, program_id string not null,
        amount_inr decimal(15,2) not null, currency string not null,
        disbursement_date date, fiscal_year string not null, grant_type string""",
    "interventions": """
        intervention_id string not null, program_id string not null,
        intervention_type string not null, title string not null,
        scheduled_date date not null, actual_date date, staff_id string,
        region_id string, planned_attendance int, actual_attendance int""",
    "beneficiaries": """
        beneficiary_id string not null, full_name string not null, age int,
        gender string, phone string, education_level string, income_bracket string,
        region_id string, registration_date date, program_id string,
        household_size int, is_disabled int""",
    "service_delivery": """
        delivery_id string not null, beneficiary_id string not null,
        intervention_id string not null, delivery_date date not null,
        status string not null, dosage int, notes string""",
    "assessments": """
        assessment_id string not null, beneficiary_id string not null,
        intervention_id string, assessment_type string not null,
        assessment_date date not null, score double, max_score double,
        assessor_staff_id string, remarks string""",
    "outcome_tracking": """
        outcome_id string not null, program_id string not null,
        indicator_id string not null, reporting_period string not null,
        target_value double, actual_value double, status string not null,
        data_source string, verified_by string""",
    "expenses": """
        expense_id string not null, program_id string not null, category string not null,
        amount_inr decimal(15,2) not null, expense_date date not null,
        fiscal_year string not null, approved_by string, receipt_available int""",
    "data_quality_log": """
        log_id string not null, table_name string not null, column_name string,
        record_id string, issue_type string not null, description string,
        detected_date date not null, resolved int not null""",
}

PRIMARY_KEY: dict[str, str] = {
    "regions": "region_id",
    "donors": "donor_id",
    "programs": "program_id",
    "staff": "staff_id",
    "impact_indicators": "indicator_id",
    "funding": "funding_id",
    "interventions": "intervention_id",
    "beneficiaries": "beneficiary_id",
    "service_delivery": "delivery_id",
    "assessments": "assessment_id",
    "outcome_tracking": "outcome_id",
    "expenses": "expense_id",
    "data_quality_log": "log_id",
}


class Reference(NamedTuple):
    child: str
    column: str
    parent: str


REFERENCES: tuple[Reference, ...] = (
    Reference("programs", "region_id", "regions"),
    Reference("staff", "region_id", "regions"),
    Reference("funding", "donor_id", "donors"),
    Reference("funding", "program_id", "programs"),
    Reference("interventions", "program_id", "programs"),
    Reference("interventions", "staff_id", "staff"),
    Reference("interventions", "region_id", "regions"),
    Reference("beneficiaries", "region_id", "regions"),
    Reference("beneficiaries", "program_id", "programs"),
    Reference("service_delivery", "beneficiary_id", "beneficiaries"),
    Reference("service_delivery", "intervention_id", "interventions"),
    Reference("assessments", "beneficiary_id", "beneficiaries"),
    Reference("assessments", "intervention_id", "interventions"),
    Reference("assessments", "assessor_staff_id", "staff"),
    Reference("outcome_tracking", "program_id", "programs"),
    Reference("outcome_tracking", "indicator_id", "impact_indicators"),
    Reference("outcome_tracking", "verified_by", "staff"),
    Reference("expenses", "program_id", "programs"),
    Reference("expenses", "approved_by", "staff"),
)

# Parents stand before their children; the issue log is copied, not cleaned.
CLEANING_ORDER: tuple[str, ...] = (
    "regions",
    "donors",
    "impact_indicators",
    "programs",
    "staff",
    "funding",
    "interventions",
    "beneficiaries",
    "service_delivery",
    "assessments",
    "outcome_tracking",
    "expenses",
)
PASS_THROUGH = "data_quality_log"


class StarEdge(NamedTuple):
    fact: str
    column: str
    dimension: str
    how: str


# Dashboard relationships, all many-to-one.
STAR_EDGES: tuple[StarEdge, ...] = (
    StarEdge("programs", "region_id", "regions", "left"),
    StarEdge("staff", "region_id", "regions", "left"),
    StarEdge("beneficiaries", "region_id", "regions", "left"),
    StarEdge("beneficiaries", "program_id", "programs", "left"),
    StarEdge("funding", "donor_id", "donors", "inner"),
    StarEdge("funding", "program_id", "programs", "inner"),
    StarEdge("expenses", "program_id", "programs", "inner"),
    StarEdge("interventions", "program_id", "programs", "inner"),
    StarEdge("interventions", "staff_id", "staff", "left"),
    StarEdge("service_delivery", "beneficiary_id", "beneficiaries", "inner"),
    StarEdge("service_delivery", "intervention_id", "interventions", "inner"),
    StarEdge("assessments", "beneficiary_id", "beneficiaries", "inner"),
    StarEdge("outcome_tracking", "program_id", "programs", "inner"),
    StarEdge("outcome_tracking", "indicator_id", "impact_indicators", "inner"),
)


def clean_schema(table: str) -> StructType:
    """Typed schema of a cleaned table."""
    fields = []
    for declared in CLEAN_COLUMNS[table].replace("\n", " ").split(", "):
        name, kind, *marks = declared.split()
        fields.append(StructField(name, _TYPES[kind], nullable=not marks))
    return StructType(fields)


def raw_schema(table: str) -> StructType:
    """All-string schema of the table as it arrives."""
    return StructType([StructField(f.name, StringType()) for f in clean_schema(table)])


def references_of(table: str) -> list[Reference]:
    return [ref for ref in REFERENCES if ref.child == table]


def star_edges_of(table: str) -> list[StarEdge]:
    return [edge for edge in STAR_EDGES if edge.fact == table]
