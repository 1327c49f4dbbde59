"""The encounter domain read out of the ``events`` table, for queries and the benchmark.

The mapping uses integer arithmetic only, so any SQL engine can repeat it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstream.sources.tables import table_stream

# The clock of every registered query, and the first of two dimension loads.
AS_OF = "2024-01-30 20:00:00"
FIRST_LOAD = "2024-01-01 08:00:00"
MALFORMED = "not json"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The glob lets the table be one file or a folder of files.
    schema = events(spark, sf_dir).schema
    return table_stream(spark, f"{sf_dir}/events.parquet*", schema)


def encounters(rows: DataFrame) -> DataFrame:
    """Typed but unrepaired encounters, one for each event."""
    event = F.col("event_id")
    return rows.select(
        "event_id",
        F.col("user_id").cast("string").alias("patient_id"),
        F.when(F.col("user_id") % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.floor("value").cast("int").alias("age"),
        F.col("event_type").alias("department"),
        F.col("ts").alias("admission_time"),
        (F.col("ts") + F.make_dt_interval(hours=(event % 72 + 1).cast("int"))).alias(
            "discharge_time"
        ),
        (event % 500 + 1).cast("int").alias("bed_id"),
        (event % 7 + 1).cast("int").alias("hospital_id"),
    )


#: Each so many events, a faulty one follows under the number -1 - event_id.
FAULTY = 97
#: What is wrong with it, in turn.
FAULTS = (
    "unreadable",
    "no patient",
    "no admission",
    "no discharge",
    "discharge before admission",
    "wrong type of age",
    "no department",
    "no bed",
)


def encounters_with_faults(rows: DataFrame) -> DataFrame:
    """The encounters and, beside them, faulty ones; ``fault`` names what is wrong, NULL if nothing."""
    event = F.col("event_id")
    kind = F.get(F.array(*map(F.lit, FAULTS)), ((event / FAULTY).cast("bigint") % len(FAULTS)).cast("int"))
    both = F.when(event % FAULTY == 0, F.array(F.lit(None).cast("string"), kind)).otherwise(
        F.array(F.lit(None).cast("string"))
    )
    typed = encounters(rows).withColumn("fault", F.explode(both))
    broken = F.coalesce(F.col("fault") == "unreadable", F.lit(False))

    def without(column: str, fault: str | None = None):
        gone = broken if fault is None else broken | F.coalesce(F.col("fault") == fault, F.lit(False))
        return F.when(~gone, F.col(column))

    early = F.col("admission_time") - F.make_dt_interval(hours=F.lit(5))
    discharge = F.when(F.col("fault") == "discharge before admission", early).otherwise(
        without("discharge_time", "no discharge")
    )
    return typed.withColumns(
        {
            "event_id": F.when(F.col("fault").isNull(), event).otherwise(-1 - event),
            "patient_id": without("patient_id", "no patient"),
            "gender": without("gender"),
            "age": without("age", "wrong type of age"),
            "department": without("department", "no department"),
            "discharge_time": discharge,
            "admission_time": without("admission_time", "no admission"),
            "bed_id": without("bed_id", "no bed"),
            "hospital_id": without("hospital_id"),
        }
    )


def wire(rows: DataFrame, faults: bool = True) -> DataFrame:
    """The encounters as broker rows, faulty ones too: JSON bytes in ``value``."""
    none = F.lit(None).cast("string")
    typed = encounters_with_faults(rows) if faults else encounters(rows).withColumn("fault", none)
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    payload = F.to_json(
        F.struct(
            "patient_id",
            "gender",
            "age",
            "department",
            F.date_format("admission_time", iso).alias("admission_time"),
            F.date_format("discharge_time", iso).alias("discharge_time"),
            "bed_id",
            "hospital_id",
        )
    )
    text = (
        F.when(F.col("fault") == "unreadable", MALFORMED)
        .when(
            F.col("fault") == "wrong type of age",
            F.concat(F.lit('{"age":"old",'), F.substring(payload, F.lit(2), F.length(payload))),
        )
        .otherwise(payload)
    )
    return typed.select("event_id", F.encode(text, "UTF-8").alias("value"))
