"""Severity classes, health marker and grades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severities from worst to mildest, and the categories that decide them.
SEVERITIES = ["outage", "quality", "degraded", "maintenance"]
QUALITY = ["boil_notice_issued", "consumption_notice_issued", "discolouration"]
DEGRADED = ["water_conservation", "low_pressure"]
HARD = ["burst_main", "reservoir_interruption", "water_treatment_plant_interruption", "pump_station_interruption", "pump_failure", "power_outage"]
REPAIR = ["mains_repair", "valve_repair", "pump_repair"]
HEALTH = ["boil_notice_issued", "consumption_notice_issued"]
LIFT_OF = {"boil_notice_issued": "boil_notice_lifted", "consumption_notice_issued": "consumption_notice_lifted"}
# Least availability of each grade.
GRADES = [(99.9, "A"), (99.75, "B"), (99.45, "C"), (99.0, "D")]


def severity(category: Column, work_type: Column, restricted: Column, low_pressure: Column, recurring: Column) -> Column:
    """The class of a notice; null for a lift, which is no event."""
    flag = lambda c: F.coalesce(c, F.lit(0)) != 0
    has = lambda names: F.coalesce(category.isin(names), F.lit(False))
    hard = has(HARD) | (has(REPAIR) & ~work_type.eqNullSafe("Planned"))
    return (
        F.when(has([*LIFT_OF.values()]), F.lit(None).cast("string"))
        .when(has(QUALITY), "quality")
        .when(has(DEGRADED) | flag(restricted) | flag(low_pressure), "degraded")
        .when(hard, F.when(recurring, "degraded").otherwise("outage"))
        .otherwise("maintenance")
    )


def rank(sev: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SEVERITIES)), sev).cast("int") - 1


def named(r: Column) -> Column:
    return F.get(F.array(*map(F.lit, SEVERITIES)), r)


def marks_health(category: Column) -> Column:
    return F.coalesce(category.isin(HEALTH), F.lit(False))


def lift_category(category: Column) -> Column:
    out = F.lit(None).cast("string")
    for issued, lifted in LIFT_OF.items():
        out = F.when(category == issued, lifted).otherwise(out)
    return out


def grade(availability: Column) -> Column:
    out = F.when(availability >= GRADES[0][0], GRADES[0][1])
    for least, name in GRADES[1:]:
        out = out.when(availability >= least, name)
    return out.otherwise("F")
