"""Titles to categories through a table of wordings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanworks.functions.text import category_prefix, only_pressure

# Category, the work type it implies (none: as reported), and the wordings that mean it.
CATEGORIES = [
    ("burst_main", "Unplanned", ["burst water main", "burst water mains", "burst main"]),
    ("essential_works", "Planned", ["essential works", "essential maintenance works", "essential maintrnance works", "maintenance works"]),
    ("leak_detection", "Planned", ["leak detection works", "leak detection/step testing", "step testing works"]),
    ("mains_flushing", "Planned", ["mains flushing", "main flushing"]),
    ("boil_notice_issued", "Unplanned", ["boil water notice"]),
    ("boil_notice_lifted", "Unplanned", ["lifting of boil water notice", "lifting of the boil water notice"]),
    ("valve_installation", "Planned", ["valve installation", "valve installation works"]),
    ("valve_repair", "Unplanned", ["valve repair works", "valve repair", "valve replacement works", "valve replacement", "valve failure"]),
    ("water_conservation", "Unplanned", ["water conservation restrictions", "water conservation", "water conservation/restrictions", "water conservation works", "water conservation/restriction", "water conservation restriction"]),
    ("hydrant_repair", "Unplanned", ["hydrant repair works", "hydrant repair", "hydrant replacement works"]),
    ("hydrant_installation", "Planned", ["hydrant installation works"]),
    ("meter_installation", "Planned", ["meter installation works", "meter installation", "meter exchange works"]),
    ("new_connection", "Planned", ["new connection works", "new connections", "mains tie-in"]),
    ("pump_station_interruption", "Unplanned", ["pump station interruption"]),
    ("pump_failure", "Unplanned", ["pump failure", "pump failure issue"]),
    ("pump_repair", "Unplanned", ["pump repair works", "pump repair"]),
    ("pump_installation", "Planned", ["pump installation works"]),
    ("discolouration", "Unplanned", ["discolouration", "discoloration"]),
    ("low_pressure", "Unplanned", ["low pressure"]),
    ("consumption_notice_issued", "Unplanned", ["do not consume", "do not consume notice"]),
    ("investigation", "Unplanned", ["investigation works", "under investigation"]),
    ("mains_rehabilitation", "Planned", ["mains rehabilitation works", "mains rehabilitation"]),
    ("reservoir_interruption", "Unplanned", ["reservoir interruption"]),
    ("reservoir_works", None, ["reservoir works", "reservoir cleaning", "reservoir upgrade works"]),
    ("water_treatment_plant_interruption", "Unplanned", ["water treatment plant interruption", "a water treatment plant interruption"]),
    ("water_treatment_plant_upgrade", "Planned", ["water treatment plant upgrade"]),
    ("consumption_notice_lifted", "Unplanned", ["lifting of do not consume", "lifting of do not consume notice"]),
    ("mains_repair", None, ["mains repair works", "mains repair", "mains repair work", "mains repairs works", "main repair works"]),
    ("power_outage", None, ["power outage"]),
]


def variant_list() -> list[str]:
    return [v for _, _, variants in CATEGORIES for v in variants]


def rule_table(spark) -> DataFrame:
    rows = [(v, slug, kind) for slug, kind, variants in CATEGORIES for v in variants]
    return spark.createDataFrame(rows, "variant string, category string, implied_work_type string")


def categorise(df: DataFrame, title: str) -> DataFrame:
    """Add ``category`` and ``implied_work_type``; null where no wording matches.  The rule table is fixed and small."""
    keyed = df.withColumn("variant", category_prefix(F.col(title)))
    return keyed.join(F.broadcast(rule_table(df.sparkSession)), "variant", "left").drop("variant")


def backfill(df: DataFrame, title: str = "title", category: str = "work_category", work_type: str = "work_type") -> DataFrame:
    """Derive category and work type where a wording matches; what is stored is never cleared."""
    out = categorise(df.drop("implied_work_type").withColumnRenamed(category, "_was"), title)
    out = out.withColumn(category, F.coalesce("category", "_was")).withColumn(work_type, F.coalesce("implied_work_type", work_type))
    return out.drop(*[c for c in ("_was", "implied_work_type", "category") if c != category])


def flag_pressure(df: DataFrame, description: str = "description", flag: str = "reduced_pressure") -> DataFrame:
    """Set the flag of notices whose text announces low pressure alone; it is never cleared, and a null flag stays null."""
    says = F.coalesce(only_pressure(F.col(description)), F.lit(False)) & F.col(description).isNotNull()
    return df.withColumn(flag, F.when((F.col(flag) == 0) & says, F.lit(1)).otherwise(F.col(flag)))


def unmatched(df: DataFrame, title: str, n: int) -> DataFrame:
    """The commonest prefixes that no rule claims."""
    keyed = df.select(category_prefix(F.col(title)).alias("variant"))
    lone = keyed.join(F.broadcast(rule_table(df.sparkSession)), "variant", "left_anti")
    return lone.groupBy("variant").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "variant").limit(n)
