"""Staging model for hospital general information.

The model is a single projection: rename, trim, flag and cast raw text columns.
It is a narrow transformation (no shuffle) and is evaluated lazily, like a view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from meridian.functions.rules import apply_rule

# The staging model's output columns, the raw column each one reads,
# and the rule applied, in output order.
HOSPITAL_COLUMNS: list[tuple[str, str, str]] = [
    ("facility_id", "facility_id", "copy"),
    ("facility_name", "facility_name", "trim"),
    ("address", "address", "trim"),
    ("city", "citytown", "trim"),
    ("state", "state", "trim"),
    ("zip5", "zip_code", "copy"),
    ("county", "countyparish", "trim"),
    ("telephone_number", "telephone_number", "trim"),
    ("hospital_type", "hospital_type", "trim"),
    ("hospital_ownership", "hospital_ownership", "trim"),
    ("emergency_services", "emergency_services", "yes_no"),
    ("meets_birthing_friendly_criteria", "meets_criteria_for_birthing_friendly_designation", "y_only"),
    ("hospital_overall_rating", "hospital_overall_rating", "int"),
    ("hospital_overall_rating_footnote", "hospital_overall_rating_footnote", "blank_to_null"),
    ("mort_group_measure_count", "mort_group_measure_count", "int"),
    ("count_of_facility_mort_measures", "count_of_facility_mort_measures", "int"),
    ("count_of_mort_measures_better", "count_of_mort_measures_better", "int"),
    ("count_of_mort_measures_no_different", "count_of_mort_measures_no_different", "int"),
    ("count_of_mort_measures_worse", "count_of_mort_measures_worse", "int"),
    ("mort_group_footnote", "mort_group_footnote", "blank_to_null"),
    ("safety_group_measure_count", "safety_group_measure_count", "int"),
    ("count_of_facility_safety_measures", "count_of_facility_safety_measures", "int"),
    ("count_of_safety_measures_better", "count_of_safety_measures_better", "int"),
    ("count_of_safety_measures_no_different", "count_of_safety_measures_no_different", "int"),
    ("count_of_safety_measures_worse", "count_of_safety_measures_worse", "int"),
    ("safety_group_footnote", "safety_group_footnote", "blank_to_null"),
    ("readm_group_measure_count", "readm_group_measure_count", "int"),
    ("count_of_facility_readm_measures", "count_of_facility_readm_measures", "int"),
    ("count_of_readm_measures_better", "count_of_readm_measures_better", "int"),
    ("count_of_readm_measures_no_different", "count_of_readm_measures_no_different", "int"),
    ("count_of_readm_measures_worse", "count_of_readm_measures_worse", "int"),
    ("readm_group_footnote", "readm_group_footnote", "blank_to_null"),
    ("pt_exp_group_measure_count", "pt_exp_group_measure_count", "int"),
    ("count_of_facility_pt_exp_measures", "count_of_facility_pt_exp_measures", "int"),
    ("pt_exp_group_footnote", "pt_exp_group_footnote", "blank_to_null"),
    ("te_group_measure_count", "te_group_measure_count", "int"),
    ("count_of_facility_te_measures", "count_of_facility_te_measures", "int"),
    ("te_group_footnote", "te_group_footnote", "blank_to_null"),
]

RAW_HOSPITAL_COLUMNS: list[str] = [raw for _, raw, _ in HOSPITAL_COLUMNS]


def conform(raw: DataFrame, columns: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Apply a declarative (output, raw, rule) projection; one narrow select."""
    spec = HOSPITAL_COLUMNS if columns is None else columns
    return raw.select(*[apply_rule(rule, src).alias(out) for out, src, rule in spec])


def conform_hospitals(raw: DataFrame) -> DataFrame:
    """The hospital staging model (38 columns)."""
    return conform(raw, HOSPITAL_COLUMNS)
