"""Report datasets, charts and the headline summary over the input layer.

The datasets of the original reports read a few columns that only exist in marts outside
this library (age group, service category, encounter group, condition group). Here they
use the nearest columns of the input layer; the functions take any table with the named
columns.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat.functions.text import AMOUNT_PLACES, exact_sum

# Row limits of the charts and the years of the cost report.
TOP_BARS = 15
TOP_SLICES = 20
TABLE_ROWS = 100
FIRST_YEAR = "2016"
LAST_YEAR = "2025"
# Columns of medical claims that the cost reports read.
COST_COLUMNS = ("claim_start_date", "paid_amount")


# -- datasets ----------------------------------------------------------------------------


def patients_dataset(patient: DataFrame, as_of: date) -> DataFrame:
    """One row per person with age and ten-year age group at ``as_of``."""
    age = F.floor(F.months_between(F.lit(as_of), "birth_date") / 12).cast("int")
    decade = (F.floor(age / 10) * 10).cast("int")
    group = F.concat(decade.cast("string"), F.lit("-"), (decade + 9).cast("string"))
    return patient.select(
        "person_id", "sex", "race", "ethnicity", age.alias("age"), group.alias("age_group"),
        "death_flag", "state",
    )


def medical_claims_dataset(medical_claim: DataFrame) -> DataFrame:
    service = F.coalesce("place_of_service_code", "bill_type_code")
    return medical_claim.select(
        "claim_id",
        "person_id",
        "claim_type",
        "payer",
        F.col("claim_type").alias("service_category_1"),
        service.alias("service_category_2"),
        "claim_start_date",
        "paid_amount",
        "allowed_amount",
    )


def encounters_dataset(encounter: DataFrame) -> DataFrame:
    return encounter.select(
        "encounter_id",
        "person_id",
        "encounter_type",
        "encounter_start_date",
        F.date_diff("encounter_end_date", "encounter_start_date").alias("length_of_stay"),
        "paid_amount",
    )


def conditions_dataset(condition: DataFrame) -> DataFrame:
    return condition.select(
        "person_id",
        F.col("condition_type").alias("condition_family"),
        F.col("source_description").alias("condition_name"),
    ).filter(F.col("condition_name").isNotNull())


def quality_measures_dataset(measures: DataFrame) -> DataFrame:
    return measures.select(
        "measure_id",
        "measure_name",
        "performance_period_end",
        F.col("denominator_sum").alias("denominator"),
        F.col("numerator_sum").alias("numerator"),
        F.col("exclusion_sum").alias("exclusions"),
        "performance_rate",
    )


def member_years(spans: DataFrame) -> DataFrame:
    """Per person and calendar year with any enrolment: year, and its enrolled months as twelve bits.

    A span gives one row per year that it touches, with a bit per month, and the bits of a
    person's spans are combined before they are shuffled: overlaps need no row per month.
    """
    years = F.sequence(F.year("enrollment_start_date"), F.year("enrollment_end_date"))
    spans = spans.filter(F.col("enrollment_start_date") <= F.col("enrollment_end_date"))
    by_year = spans.select("person_id", "enrollment_start_date", "enrollment_end_date", F.explode(years).alias("year"))
    first = F.when(F.year("enrollment_start_date") == F.col("year"), F.month("enrollment_start_date")).otherwise(1)
    last = F.when(F.year("enrollment_end_date") == F.col("year"), F.month("enrollment_end_date")).otherwise(12)
    # bits first - 1 to last - 1
    bits = F.expr("shiftleft(1, __last) - shiftleft(1, __first - 1)")
    bounded = by_year.select("person_id", "year", first.alias("__first"), last.alias("__last"))
    return bounded.groupBy("person_id", "year").agg(F.bit_or(bits).alias("months"))


def member_months(spans: DataFrame) -> DataFrame:
    """One row per person and calendar month with any enrolment."""
    numbers = F.expr("filter(sequence(1, 12), m -> (months & shiftleft(1, m - 1)) > 0)")
    return member_years(spans).select("person_id", "year", F.explode(numbers).alias("__month")).select(
        "person_id",
        F.concat(F.lpad(F.col("year").cast("string"), 4, "0"), F.lpad(F.col("__month").cast("string"), 2, "0")).alias("year_month"),
    )


def cost_per_member_month(
    months: DataFrame,
    medical_claim: DataFrame,
    first_year: str = FIRST_YEAR,
    last_year: str = LAST_YEAR,
    places: int = AMOUNT_PLACES,
) -> DataFrame:
    """Medical paid per member per month, by calendar year, from a table of member months. The
    year filter reaches both inputs, so rows of other years are dropped before they are grouped."""
    by_year = months.select(F.substr("year_month", F.lit(1), F.lit(4)).alias("year"), F.lit(1).alias("__months"))
    return _cost_by_year(by_year, medical_claim, first_year, last_year, places)


def cost_of_member_years(
    years: DataFrame,
    medical_claim: DataFrame,
    first_year: str = FIRST_YEAR,
    last_year: str = LAST_YEAR,
    places: int = AMOUNT_PLACES,
) -> DataFrame:
    """The rows of :func:`cost_per_member_month` from :func:`member_years`: months are counted by
    their bits, no row stands for one."""
    by_year = years.select(F.lpad(F.col("year").cast("string"), 4, "0").alias("year"), F.bit_count("months").alias("__months"))
    return _cost_by_year(by_year, medical_claim, first_year, last_year, places)


def _cost_by_year(
    by_year: DataFrame, medical_claim: DataFrame, first_year: str, last_year: str, places: int
) -> DataFrame:
    member = (
        by_year.filter(F.col("year").between(first_year, last_year))
        .groupBy("year")
        .agg(F.sum("__months").alias("member_months"))
    )
    paid = (
        medical_claim.select(F.year("claim_start_date").cast("string").alias("__year"), "paid_amount")
        .filter(F.col("__year").between(first_year, last_year))
        .groupBy("__year")
        .agg(exact_sum(F.col("paid_amount"), places).alias("__paid"))
    )
    total = F.coalesce("__paid", F.lit(0.0))
    return member.join(paid, F.col("year") == F.col("__year"), "left").select(
        "year",
        "member_months",
        total.alias("paid"),
        (total / F.col("member_months")).alias("pmpm"),
    )


# -- charts ------------------------------------------------------------------------------


def top_groups(df: DataFrame, by: str, metric: Column, name: str, n: int) -> DataFrame:
    """The ``n`` groups with the largest metric; equal metrics are ordered by group."""
    grouped = df.groupBy(by).agg(metric.alias(name))
    return grouped.orderBy(F.col(name).desc_nulls_last(), F.col(by).asc_nulls_last()).limit(n)


def groups_in_order(df: DataFrame, by: str, metric: Column, name: str, n: int) -> DataFrame:
    """The first ``n`` groups in the order of the group itself."""
    return df.groupBy(by).agg(metric.alias(name)).orderBy(F.col(by).asc_nulls_last()).limit(n)


def patient_count(patients: DataFrame) -> DataFrame:
    return patients.agg(F.count_distinct("person_id").alias("patients"))


def medical_paid(claims: DataFrame, places: int = AMOUNT_PLACES) -> DataFrame:
    return claims.agg(exact_sum(F.col("paid_amount"), places).alias("paid"))


def encounter_count(encounters: DataFrame) -> DataFrame:
    return encounters.agg(F.count(F.lit(1)).alias("encounters"))


def average_cost_per_member_month(pmpm: DataFrame) -> DataFrame:
    return pmpm.agg((exact_sum(F.col("paid")) / F.sum("member_months")).alias("pmpm"))


def cost_per_member_month_by_year(pmpm: DataFrame) -> DataFrame:
    ratio = exact_sum(F.col("paid")) / F.sum("member_months")
    return groups_in_order(pmpm, "year", ratio, "pmpm", TOP_SLICES)


def paid_by_service_category(claims: DataFrame, places: int = AMOUNT_PLACES) -> DataFrame:
    return top_groups(claims, "service_category_2", exact_sum(F.col("paid_amount"), places), "paid", TOP_BARS)


def _people() -> Column:
    return F.count_distinct("person_id")


def patients_by_age_group(patients: DataFrame) -> DataFrame:
    return groups_in_order(patients, "age_group", _people(), "patients", TOP_BARS)


def patients_by_sex(patients: DataFrame) -> DataFrame:
    return top_groups(patients, "sex", _people(), "patients", TOP_SLICES)


def patients_by_race(patients: DataFrame) -> DataFrame:
    return top_groups(patients, "race", _people(), "patients", TOP_SLICES)


def encounters_by_type(encounters: DataFrame) -> DataFrame:
    return top_groups(encounters, "encounter_type", F.count(F.lit(1)), "encounters", TOP_BARS)


def common_conditions(conditions: DataFrame) -> DataFrame:
    return top_groups(conditions, "condition_name", _people(), "patients", TOP_BARS)


def quality_measure_table(measures: DataFrame) -> DataFrame:
    columns = ("measure_id", "measure_name", "denominator", "numerator", "exclusions", "performance_rate")
    return measures.select(*columns).orderBy("measure_id").limit(TABLE_ROWS)


# -- summary -----------------------------------------------------------------------------


def headline_summary(
    spark: SparkSession,
    patient: DataFrame | None = None,
    encounter: DataFrame | None = None,
    medical_claim: DataFrame | None = None,
    pharmacy_claim: DataFrame | None = None,
    measures: DataFrame | None = None,
    places: int = AMOUNT_PLACES,
) -> DataFrame:
    """One row: four counts and the paid total; a table that is not there gives null. With
    ``measures`` also quality_measures: the rows of :func:`measure_list` as an array, by id. Its
    length is the number of measures, not that of persons."""

    def measured(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.agg(value.cast("double").alias("value")).select(F.lit(name).alias("name"), "value")

    rows = F.count(F.lit(1))
    parts = [
        measured(df, name, rows)
        for df, name in (
            (patient, "patients"),
            (encounter, "encounters"),
            (pharmacy_claim, "pharmacy_claim_lines"),
        )
        if df is not None
    ]
    if medical_claim is not None:
        paid = F.round(exact_sum(F.col("paid_amount"), places), 2)
        totals = medical_claim.agg(rows.cast("double").alias("medical_claim_lines"), paid.alias("paid_amount"))
        names = ["medical_claim_lines", "paid_amount"]
        parts.append(totals.unpivot([], names, "name", "value"))
    tall = spark.createDataFrame([], "name string, value double")
    for p in parts:
        tall = tall.unionByName(p)

    def pick(name: str, dtype: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col("value"))).cast(dtype).alias(name)

    listed = []
    if measures is not None:
        entry = F.struct("measure_id", "name", "denominator", "numerator", "exclusions", "rate")
        entries = measure_list(measures).agg(F.sort_array(F.collect_list(entry)).alias("list"))
        tall = tall.unionByName(entries, allowMissingColumns=True)
        listed = [F.first("list", ignorenulls=True).alias("quality_measures")]
    return tall.agg(
        pick("patients", "bigint"),
        pick("encounters", "bigint"),
        pick("medical_claim_lines", "bigint"),
        pick("pharmacy_claim_lines", "bigint"),
        pick("paid_amount", "double"),
        *listed,
    )


def measure_list(measures: DataFrame) -> DataFrame:
    """Measure results in order of their id."""
    return measures.select(
        "measure_id",
        F.col("measure_name").alias("name"),
        F.col("denominator_sum").alias("denominator"),
        F.col("numerator_sum").alias("numerator"),
        F.col("exclusion_sum").alias("exclusions"),
        F.col("performance_rate").alias("rate"),
    ).orderBy("measure_id")
