"""Type-1 department dimension and the date dimension."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstream.functions.keys import hashed_key


def dim_department(latest: DataFrame) -> DataFrame:
    """One row per (department, hospital), rebuilt each run; the key depends only on the pair."""
    pairs = latest.select("department", "hospital_id").distinct()
    return pairs.select(
        hashed_key("department", "hospital_id").alias("surrogate_key"), "department", "hospital_id"
    )


def dim_time(fact: DataFrame, date: str = "admission_date") -> DataFrame:
    """One row per calendar day between the first and last date of the fact."""
    span = fact.agg(F.min(date).alias("first"), F.max(date).alias("last"))
    # An empty fact has no span, hence no days. Years are spread over tasks before their days arise.
    years = (
        span.filter("first IS NOT NULL")
        .select("first", "last", F.explode(F.sequence(F.year("first"), F.year("last"))).alias("y"))
        .repartition("y")
    )
    days = years.select(
        F.explode(
            F.sequence(
                F.greatest("first", F.make_date("y", F.lit(1), F.lit(1))),
                F.least("last", F.make_date("y", F.lit(12), F.lit(31))),
            )
        ).alias("date")
    )
    return days.select(
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.day("date").alias("day"),
        F.weekofyear("date").alias("iso_week"),
        (F.weekday("date") + 1).alias("iso_weekday"),
        (F.weekday("date") >= 5).alias("is_weekend"),
    )
