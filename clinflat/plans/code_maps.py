"""Code maps: one target per source code, from terminology tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflat.functions.text import strip_dots
from clinflat.operators.ranking import first_per_key

ACTIVE_VALUES = ("1", "true", "True")


def diagnosis_code_map(diagnosis_map: DataFrame) -> DataFrame:
    """One ICD-10-CM code per SNOMED code: the first active target that applies without
    a condition, by map group, then priority."""
    usable = diagnosis_map.filter(
        F.col("active").cast("string").isin(*ACTIVE_VALUES)
        & (F.col("map_target") != "")
        & F.upper("map_rule").isin("TRUE", "OTHERWISE TRUE")
    ).select(
        F.col("referenced_component_id").cast("string").alias("snomed_code"),
        strip_dots(F.col("map_target")).alias("icd10_code"),
        F.col("map_target_name").alias("icd10_description"),
        F.col("map_group").cast("int").alias("__group"),
        F.col("map_priority").cast("int").alias("__priority"),
    )
    return first_per_key(
        usable,
        ["snomed_code"],
        [F.col("__group"), F.col("__priority")],
        ["icd10_code", "icd10_description"],
    )


def drug_package_map(packages: DataFrame) -> DataFrame:
    """One package code per drug, whichever of its two ids is used: active packages first,
    then the lowest code."""
    rows = packages.filter(F.col("ndc11").isNotNull()).select(
        F.explode(F.array(F.col("drug_id").cast("string"), F.col("clinical_drug_id").cast("string"))).alias("rxnorm_code"),
        (~F.coalesce(F.col("active").cast("string").isin(*ACTIVE_VALUES), F.lit(False))).alias("__old"),
        "ndc11",
    )
    best = first_per_key(rows, ["rxnorm_code"], [F.col("__old")], ["ndc11"])
    return best.select(
        "rxnorm_code", F.lpad(F.col("ndc11").cast("string"), 11, "0").alias("ndc_code")
    )
