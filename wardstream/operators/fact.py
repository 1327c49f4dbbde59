"""Fact table: look up both dimensions, derive the stay metrics."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstream import schemas
from wardstream.functions.clock import hours_between, now

COLUMNS = schemas.FACT.names


def fact_patient_flow(
    encounters: DataFrame,
    dim_patient: DataFrame,
    dim_department: DataFrame,
    as_of=None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One fact row per encounter row given.

    Pass the latest encounter per patient for the patient grain, or all accepted encounters for
    the visit grain. Unmatched lookups give a NULL key. The department lookup comes first: its
    dimension is small, and once its key replaces the text a narrower row is shuffled for the
    patient lookup. Neither side is forced to broadcast: the planner does so only below its size
    limit, and beyond that a hot patient or department is split by the skew join. ``keep`` names columns of the
    encounters that stay beside the fact's own.
    """
    departments = dim_department.select(
        F.col("surrogate_key").alias("department_sk"), "department", "hospital_id"
    )
    patients = dim_patient.filter("is_current").select(
        F.col("surrogate_key").alias("patient_sk"), "patient_id"
    )
    rows = encounters.select(
        "event_id",
        "patient_id",
        "department",
        "hospital_id",
        "admission_time",
        "discharge_time",
        "bed_id",
        *keep,
    )
    keyed = (
        rows.join(departments, ["department", "hospital_id"], "left")
        .drop("department", "hospital_id")
        .join(patients, "patient_id", "left")
    )
    return keyed.select(
        F.col("event_id").alias("fact_id"),
        "patient_sk",
        "department_sk",
        "admission_time",
        "discharge_time",
        F.to_date("admission_time").alias("admission_date"),
        hours_between("admission_time", "discharge_time").alias("length_of_stay_hours"),
        F.coalesce(F.col("discharge_time") > now(as_of), F.lit(False)).alias(
            "is_currently_admitted"
        ),
        "bed_id",
        now(as_of).alias("event_ingestion_time"),
        *keep,
    )


def write_fact_by_date(fact: DataFrame, path: str) -> None:
    """Overwrite only the dates present in ``fact``.

    The rebalance gathers each date into few files and splits a date that holds much of the data
    over many tasks.
    """
    (
        fact.hint("rebalance", "admission_date")
        .write.partitionBy("admission_date")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def read_fact(spark, path: str) -> DataFrame:
    return spark.read.schema(schemas.FACT).parquet(path).select(*COLUMNS)
