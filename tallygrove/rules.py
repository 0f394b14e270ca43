"""Cleaning rules as data, so that the operators work on any table.

Fixed values: column lists, value maps, bounds, match keys, fill strategies
and missing-value marks below decide the results and are stated as they are.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

DATE_COLUMNS = {
    "beneficiaries": ("registration_date",),
    "service_delivery": ("delivery_date",),
    "assessments": ("assessment_date",),
    "funding": ("disbursement_date",),
    "interventions": ("scheduled_date", "actual_date"),
    "expenses": ("expense_date",),
    "staff": ("hire_date",),
    "donors": ("onboarded_date",),
    "programs": ("start_date", "end_date"),
}

GENDERS = {
    "male": "Male",
    "m": "Male",
    "female": "Female",
    "f": "Female",
    "non-binary": "Non-Binary",
    "nb": "Non-Binary",
    "n": "Non-Binary",
    "prefer not to say": "Prefer Not to Say",
    "p": "Prefer Not to Say",
}

SERVICE_STATUSES = {
    "completed": "Completed",
    "c": "Completed",
    "partially completed": "Partially Completed",
    "scheduled": "Scheduled",
    "s": "Scheduled",
    "cancelled": "Cancelled",
    "canceled": "Cancelled",
    "no-show": "No-Show",
    "no show": "No-Show",
    "n": "No-Show",
}

ASSESSMENT_TYPES = {
    "pre-test": "Pre-Test",
    "pre test": "Pre-Test",
    "pretest": "Pre-Test",
    "post-test": "Post-Test",
    "post test": "Post-Test",
    "posttest": "Post-Test",
    "midline survey": "Midline Survey",
    "endline survey": "Endline Survey",
    "spot check": "Spot Check",
    "follow-up interview": "Follow-Up Interview",
    "follow up interview": "Follow-Up Interview",
}

OUTCOME_STATUSES = {
    "on track": "On Track",
    "at risk": "At Risk",
    "off track": "Off Track",
    "achieved": "Achieved",
    "exceeded": "Exceeded",
}

# Inclusive; ``None`` is open.
BOUNDS = {
    "age": (0, 110),
    "household_size": (1, 20),
    "score": (0.0, None),
    "dosage": (0, 50),
    "planned_attendance": (0, 1000),
    "actual_attendance": (0, 1000),
    "amount_inr": (100.0, 100_000_000.0),
}

# Upper bound held in a sibling column.
COLUMN_BOUNDS = {"score": "max_score"}

MATCH_KEYS = {
    "beneficiaries": ("full_name", "phone", "region_id"),
    "service_delivery": ("beneficiary_id", "intervention_id", "delivery_date"),
    "assessments": ("beneficiary_id", "assessment_type", "assessment_date"),
    "staff": ("full_name", "phone"),
    "funding": ("donor_id", "program_id", "disbursement_date"),
}

FILL = {
    "beneficiaries": {
        "age": "median",
        "gender": "unknown",
        "phone": "skip",
        "education_level": "unknown",
        "income_bracket": "unknown",
        "household_size": "median",
        "is_disabled": "zero",
        "registration_date": "skip",
    },
    "service_delivery": {"dosage": "median", "notes": "skip", "delivery_date": "skip"},
    "assessments": {
        "score": "skip",
        "remarks": "skip",
        "intervention_id": "skip",
        "max_score": "skip",
    },
    "funding": {"grant_type": "unknown", "disbursement_date": "skip"},
    "staff": {"phone": "skip", "email": "skip", "hire_date": "skip"},
}

INTEGER_COLUMNS = frozenset(
    {
        "age",
        "household_size",
        "is_disabled",
        "is_active",
        "planned_attendance",
        "actual_attendance",
        "dosage",
        "target_beneficiaries",
        "receipt_available",
        "resolved",
    }
)
FLOAT_COLUMNS = frozenset(
    {
        "score",
        "max_score",
        "target_value",
        "actual_value",
        "amount_inr",
        "latitude",
        "longitude",
    }
)

DUPLICATE_TAG = "-DUP"

# Columns watched by the issue log, per table.
MONITORED_NULLS = {
    "beneficiaries": ("phone", "age", "income_bracket", "education_level"),
    "service_delivery": ("dosage", "notes"),
    "assessments": ("score", "remarks"),
    "funding": ("grant_type",),
    "staff": ("phone", "email"),
}
NAME_COLUMNS = {"beneficiaries": ("full_name", "region_id"), "staff": ("full_name", "region_id")}

# Texts that a CSV reader takes for a missing value.
MISSING_MARKS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class CleaningRules:
    """Everything the cleaning operators look up, with the defaults above."""

    date_columns: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: DATE_COLUMNS)
    bounds: Mapping[str, tuple] = field(default_factory=lambda: BOUNDS)
    column_bounds: Mapping[str, str] = field(default_factory=lambda: COLUMN_BOUNDS)
    match_keys: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: MATCH_KEYS)
    fill: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: FILL)
    monitored_nulls: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: MONITORED_NULLS
    )
    name_columns: Mapping[str, tuple[str, str]] = field(default_factory=lambda: NAME_COLUMNS)
    integer_columns: frozenset[str] = INTEGER_COLUMNS
    float_columns: frozenset[str] = FLOAT_COLUMNS
    duplicate_tag: str = DUPLICATE_TAG

    def value_maps(self, table: str) -> dict[str, Mapping[str, str]]:
        """Canonical value map per categorical column of ``table``."""
        statuses = SERVICE_STATUSES if table == "service_delivery" else OUTCOME_STATUSES
        return {"gender": GENDERS, "status": statuses, "assessment_type": ASSESSMENT_TYPES}


DEFAULT_RULES = CleaningRules()
