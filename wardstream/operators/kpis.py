"""KPIs over the star schema.

Every measure is built from per-row counts that add up, so the plan is the same for all: shuffle
the fact once, by patient, to meet the patient dimension, sum on the map side before the small
shuffle of the groups, and look up the department only after the rows are down to a few groups.

``fact_id`` is the fact's primary key, so counting distinct facts is counting facts.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: stays above this many hours are overstays.
OVERSTAY_HOURS = 50


@dataclass(frozen=True)
class Star:
    """The three gold tables.

    ``grain`` is "patient" (one fact per patient) or "visit" (one per encounter). At visit grain
    a single patient may hold a large share of the fact.
    """

    fact: DataFrame
    patients: DataFrame
    departments: DataFrame
    grain: str = "patient"


def _tally(test: Column) -> Column:
    return F.when(test, 1).otherwise(0).cast("bigint")


def _sums(names) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _by_gender(
    star: Star, keys: list[str], parts: dict[str, Column], where=None, gender: str | None = None
) -> DataFrame:
    """Sums of ``parts`` by gender and the fact columns ``keys``. ``gender`` slices the report."""
    fact = star.fact if where is None else star.fact.filter(where)
    rows = fact.select("patient_sk", *keys, *(c.alias(n) for n, c in parts.items()))
    if star.grain == "visit" and not keys:
        # A patient with many visits becomes a row per map task, and the sum needs no shuffle
        # besides the join's. With more keys it would need its own, and shrink little: there the
        # skew join splits a patient with many visits.
        rows = rows.groupBy("patient_sk", *keys).agg(*_sums(parts))
    patients = star.patients.select(F.col("surrogate_key").alias("patient_sk"), "gender")
    if gender is not None:
        patients = patients.filter(F.col("gender") == gender)
    return rows.join(patients, "patient_sk").groupBy("gender", *keys).agg(*_sums(parts))


def _by_department(star: Star, parts: dict[str, Column], where=None, gender=None) -> DataFrame:
    """Sums of ``parts`` by department and gender."""
    grouped = _by_gender(star, ["department_sk"], parts, where, gender)
    departments = star.departments.select(
        F.col("surrogate_key").alias("department_sk"), "department"
    )
    return (
        grouped.join(departments, "department_sk")
        .groupBy("department", "gender")
        .agg(*_sums(parts))
    )


def _share(part: str, whole: str) -> Column:
    """Quotient as a double, NULL for an empty whole."""
    return F.col(part).cast("double") / F.nullif(F.col(whole), F.lit(0))


def _admitted() -> Column:
    return _tally(F.col("is_currently_admitted"))


def _beds() -> dict[str, Column]:
    bed = F.col("bed_id").isNotNull()
    return {"in_use": _tally(F.col("is_currently_admitted") & bed), "beds": _tally(bed)}


def _facts() -> Column:
    return F.lit(1).cast("bigint")


def bed_occupancy(star: Star, gender: str | None = None) -> DataFrame:
    """Share of facts with a bed whose patient is still admitted, by gender, in percent."""
    return _by_gender(star, [], _beds(), gender=gender).select(
        "gender", (_share("in_use", "beds") * 100).alias("bed_occupancy_percent")
    )


def bed_occupancy_dept(star: Star, gender: str | None = None) -> DataFrame:
    """Bed occupancy by department and gender."""
    return _by_department(star, _beds(), gender=gender).select(
        "department", "gender", (_share("in_use", "beds") * 100).alias("bed_occupancy_percent")
    )


def bed_turnover_rate(star: Star, gender: str | None = None) -> DataFrame:
    """Facts per distinct bed, by gender.

    Beds are marked in bitmaps, a bit for each of 32768 numbers, so what is exchanged after the patient lookup is a row of at most
    4 KB per task, gender and range of bed numbers, not one for each bed.
    """
    rows = star.fact.select(
        "patient_sk",
        F.bitmap_bucket_number("bed_id").alias("beds_from"),
        F.bitmap_bit_position("bed_id").alias("bit"),
    )
    patients = star.patients.select(F.col("surrogate_key").alias("patient_sk"), "gender")
    if gender is not None:
        patients = patients.filter(F.col("gender") == gender)
    ranges = rows.join(patients, "patient_sk").groupBy("gender", "beds_from").agg(
        F.count(F.lit(1)).alias("facts"),
        F.bitmap_construct_agg("bit").alias("marked"),
    )
    # Facts without a bed are a range of their own, whose bitmap is empty.
    marked = F.when(F.col("beds_from").isNotNull(), F.bitmap_count("marked")).otherwise(0)
    totals = ranges.groupBy("gender").agg(F.sum("facts").alias("facts"), F.sum(marked).alias("beds"))
    return totals.select("gender", _share("facts", "beds").alias("bed_turnover_rate"))


def patient_demographics(star: Star, gender: str | None = None) -> DataFrame:
    """Currently admitted, by gender."""
    return _by_gender(star, [], {"total_patients": _admitted()}, gender=gender).select(
        "gender", "total_patients"
    )


def avg_treatment_duration(star: Star, gender: str | None = None) -> DataFrame:
    """Mean stay in hours by department and gender; open-ended stays are left out."""
    stay = F.col("length_of_stay_hours")
    parts = {"hours": stay, "stays": _tally(stay.isNotNull())}
    return _by_department(star, parts, gender=gender).select(
        "department", "gender", _share("hours", "stays").alias("avg_treatment_duration")
    )


def patient_volume_trend(star: Star, gender: str | None = None) -> DataFrame:
    """Facts per admission date and gender."""
    one = {"patient_count": _facts()}
    return _by_gender(star, ["admission_date"], one, gender=gender).select(
        "admission_date", "gender", "patient_count"
    )


def department_inflow(star: Star, gender: str | None = None) -> DataFrame:
    """Currently admitted by department and gender; groups with none are kept as zero."""
    return _by_department(star, {"patient_count": _admitted()}, gender=gender).select(
        "department", "gender", "patient_count"
    )


def overstay_patients(star: Star, gender: str | None = None) -> DataFrame:
    """Stays above the limit by department and gender; groups with none are left out."""
    over = F.col("length_of_stay_hours") > OVERSTAY_HOURS
    one = {"overstay_count": _facts()}
    return _by_department(star, one, over, gender).select("department", "gender", "overstay_count")


KPIS = {
    f.__name__: f
    for f in (
        bed_occupancy,
        bed_turnover_rate,
        patient_demographics,
        avg_treatment_duration,
        patient_volume_trend,
        department_inflow,
        overstay_patients,
        bed_occupancy_dept,
    )
}
