"""Column contracts of every layer.

All times are ``TIMESTAMP_NTZ`` holding the UTC wall clock, so results do not move with
the session time zone.
"""

from pyspark.sql import types as T

# Field and column names, in contract order.
EVENT = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("department", T.StringType()),
        T.StructField("admission_time", T.StringType()),
        T.StructField("discharge_time", T.StringType()),
        T.StructField("bed_id", T.IntegerType()),
        T.StructField("hospital_id", T.IntegerType()),
    ]
)

# Ingest metadata kept beside the payload: the broker position makes every event identifiable.
BRONZE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("raw_json", T.StringType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
    ]
)

# What a broker adds: bronze rows from one carry these too.
BRONZE_BROKER = T.StructType(
    [
        *BRONZE,
        T.StructField("broker_partition", T.IntegerType()),
        T.StructField("broker_offset", T.LongType()),
        T.StructField("broker_time", T.TimestampNTZType()),
        T.StructField("broker_key", T.StringType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("patient_id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("department", T.StringType()),
        T.StructField("admission_time", T.TimestampNTZType()),
        T.StructField("discharge_time", T.TimestampNTZType()),
        T.StructField("bed_id", T.IntegerType()),
        T.StructField("hospital_id", T.IntegerType()),
        T.StructField("arrived_at", T.TimestampNTZType()),
    ]
)

DIM_PATIENT = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("effective_from", T.TimestampNTZType()),
        T.StructField("surrogate_key", T.LongType()),
        T.StructField("effective_to", T.TimestampNTZType()),
        T.StructField("is_current", T.BooleanType()),
    ]
)

DIM_DEPARTMENT = T.StructType(
    [
        T.StructField("surrogate_key", T.LongType()),
        T.StructField("department", T.StringType()),
        T.StructField("hospital_id", T.IntegerType()),
    ]
)

FACT = T.StructType(
    [
        T.StructField("fact_id", T.LongType()),
        T.StructField("patient_sk", T.LongType()),
        T.StructField("department_sk", T.LongType()),
        T.StructField("admission_time", T.TimestampNTZType()),
        T.StructField("discharge_time", T.TimestampNTZType()),
        T.StructField("admission_date", T.DateType()),
        T.StructField("length_of_stay_hours", T.DoubleType()),
        T.StructField("is_currently_admitted", T.BooleanType()),
        T.StructField("bed_id", T.IntegerType()),
        T.StructField("event_ingestion_time", T.TimestampNTZType()),
    ]
)

# Attributes whose change opens a new patient version.
TRACKED = ("gender", "age")


def ddl(schema: T.StructType) -> str:
    """Column list for ``CREATE TABLE`` from a contract."""
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema)
