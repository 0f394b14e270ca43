"""Labels and classes.

Fixed values: label texts, band limits and thresholds are part of the output.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygrove.functions.numbers import percent_of


def age_cohort(age: Column) -> Column:
    """Age bands of the reach report."""
    return (
        F.when(age.isNull(), "Unknown")
        .when(age < 6, "0-5 (Early Childhood)")
        .when(age.between(6, 14), "6-14 (School Age)")
        .when(age.between(15, 24), "15-24 (Youth)")
        .when(age.between(25, 44), "25-44 (Working Age)")
        .when(age.between(45, 59), "45-59 (Middle Age)")
        .otherwise("60+ (Senior)")
    )


def life_stage(age: Column) -> Column:
    """Age bands of the effectiveness report."""
    return (
        F.when(age.isNull(), "Unknown")
        .when(age < 15, "Child (0-14)")
        .when(age.between(15, 24), "Youth (15-24)")
        .when(age.between(25, 59), "Adult (25-59)")
        .otherwise("Senior (60+)")
    )


def traffic_light(value: Column, green: float, amber: float) -> Column:
    """GREEN and AMBER from their thresholds upwards, else RED (also on NULL)."""
    return F.when(value >= green, "GREEN").when(value >= amber, "AMBER").otherwise("RED")


def traffic_light_low(value: Column, green: float, amber: float) -> Column:
    """GREEN and AMBER up to their thresholds, else RED (also on NULL)."""
    return F.when(value <= green, "GREEN").when(value <= amber, "AMBER").otherwise("RED")


def achievement_light(actual: Column, target: Column) -> Column:
    return traffic_light(percent_of(actual, target), 90, 70)


def momentum(actual: Column, previous: Column) -> Column:
    return (
        F.when(previous.isNull(), "N/A (First Quarter)")
        .when(actual > previous, "↑ Improving")
        .when(actual == previous, "→ Stable")
        .otherwise("↓ Declining")
    )


def outcome_direction(before: Column, after: Column) -> Column:
    return (
        F.when(after > before, "Improved").when(after == before, "No Change").otherwise("Declined")
    )


def disability_status(flag: Column) -> Column:
    return (
        F.when(flag == 1, "Person with Disability")
        .when(flag == 0, "No Disability")
        .otherwise("Not Recorded")
    )


def pwd_flag(flag: Column) -> Column:
    return F.when(flag == 1, "PwD").otherwise("No")


def verification_status(verifier: Column) -> Column:
    return F.when(verifier.isNotNull(), "Verified").otherwise("Unverified")


def beneficiary_status(services: Column) -> Column:
    return F.when(F.coalesce(services, F.lit(0)) > 0, "Active").otherwise("Registered Only")


def outcome_status(actual: Column, target: Column) -> Column:
    """Status class of an actual against its target; a target of 0 counts as ratio 0."""
    ratio = F.when(target > 0, actual / target).otherwise(0.0)
    return (
        F.when(ratio >= 1.1, "Exceeded")
        .when(ratio >= 1.0, "Achieved")
        .when(ratio >= 0.8, "On Track")
        .when(ratio >= 0.5, "At Risk")
        .otherwise("Off Track")
    )


def program_status(end_date: Column, cutoff: dt.date = dt.date(2025, 1, 1)) -> Column:
    """Active without an end date or with one after the cut-off."""
    return F.when(end_date.isNull() | (end_date > F.lit(cutoff)), "Active").otherwise("Completed")
