"""Decode, parse, type and repair events. Every function here is row-wise: no shuffle, no state."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstream import schemas
from wardstream.functions.clock import now, parse_time

# Ages above the limit are dirty, and are replaced by one of 1..90.
MAX_AGE = 100
IMPUTED_AGES = 90


def bronze_decode(wire: DataFrame, as_of=None) -> DataFrame:
    """Broker rows to bronze: ``value`` bytes as text, beside the event's identity.

    A frame without ``event_id`` must carry the broker's ``partition`` and ``offset``; both are
    packed into one BIGINT (19 and 44 bits), unique within the topic. Such rows keep what the broker
    says of them besides: partition, offset, timestamp and key.
    """
    broker = []
    if "event_id" in wire.columns:
        event_id = F.col("event_id")
    else:
        event_id = F.shiftleft(F.col("partition").cast("bigint"), 44) + F.col("offset")
        have = set(wire.columns)
        zone = F.current_timezone()
        time = F.convert_timezone(zone, F.lit("UTC"), F.col("timestamp").cast("timestamp_ntz"))
        broker = [
            F.col("partition").cast("int").alias("broker_partition"),
            F.col("offset").cast("bigint").alias("broker_offset"),
            (time if "timestamp" in have else F.lit(None).cast("timestamp_ntz")).alias(
                "broker_time"
            ),
            (F.col("key") if "key" in have else F.lit(None)).cast("string").alias("broker_key"),
        ]
    return wire.select(
        event_id.alias("event_id"),
        F.col("value").cast("string").alias("raw_json"),
        now(as_of).alias("ingested_at"),
        *broker,
    )


def arrival(bronze: DataFrame) -> Column:
    """When the event arrived: by the broker's clock, else by ours."""
    if "broker_time" in bronze.columns:
        return F.coalesce("broker_time", "ingested_at")
    return F.col("ingested_at")


def parse_events(bronze: DataFrame, *keep: Column | str) -> DataFrame:
    """JSON text to the declared fields. Unreadable text gives a row of NULLs. ``keep``: columns of
    bronze that stay beside them."""
    parsed = F.from_json("raw_json", schemas.EVENT).alias("data")
    kept = bronze.select("event_id", parsed, *keep)
    return kept.select("event_id", "data.*", *kept.columns[2:])


def type_times(parsed: DataFrame) -> DataFrame:
    """Both time fields from text to timestamps; text that is not a time becomes NULL."""
    return parsed.withColumns(
        {c: parse_time(c) for c in ("admission_time", "discharge_time")}
    )


def clamp_admission(events: DataFrame, as_of=None) -> DataFrame:
    """Missing and future admissions are set to the clock."""
    c = F.col("admission_time")
    return events.withColumn("admission_time", F.when(c <= now(as_of), c).otherwise(now(as_of)))


def impute_age(events: DataFrame, seed: str | Column = "event_id") -> DataFrame:
    """Ages above the limit are replaced by a value in 1..90 fixed by the event's own number."""
    seed = F.col(seed) if isinstance(seed, str) else seed
    drawn = (F.pmod(seed, F.lit(IMPUTED_AGES)) + 1).cast("int")
    return events.withColumn("age", F.when(F.col("age") > MAX_AGE, drawn).otherwise(F.col("age")))


def conform_schema(df: DataFrame, schema: T.StructType = schemas.SILVER) -> DataFrame:
    """Exactly the contract's columns and types: missing ones become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def clean_events(bronze: DataFrame, as_of=None, dq: str | Observation | None = None) -> DataFrame:
    """Bronze to silver. Rows that cannot be used are still present; see :func:`accepted`.

    ``dq`` names an observation that counts rule violations while the rows pass by, without a
    second scan; a stream reports it in each batch's progress.
    """
    arrived = arrival(bronze).alias("arrived_at")
    if dq is None:
        typed = type_times(parse_events(bronze, arrived))
    else:
        wrong = F.count_if(wrong_type()).alias("wrong_type")
        typed = type_times(parse_events(bronze, arrived, "raw_json"))
        typed = typed.observe(dq, *dq_counts(as_of), wrong)
    return conform_schema(impute_age(clamp_admission(typed, as_of)))


def accepted(silver: DataFrame) -> DataFrame:
    """Rows that may enter the star schema: those that name a patient."""
    return silver.filter(F.col("patient_id").isNotNull())


def quarantine(silver: DataFrame) -> DataFrame:
    """Rows kept out of the star schema, with the reason."""
    return silver.filter(F.col("patient_id").isNull()).withColumn(
        "reason", F.lit("missing patient_id")
    )


def rejected_input(bronze: DataFrame) -> DataFrame:
    """The raw text that led to quarantined rows, kept for repair, with the reason."""
    parsed = F.from_json("raw_json", schemas.EVENT)
    reason = (
        F.when(F.coalesce(F.trim("raw_json"), F.lit("")) == "", "empty")
        # A record with a field of a wrong type is readable: it has keys.
        .when(F.json_object_keys("raw_json").isNull(), "unreadable")
        .otherwise("missing patient_id")
    )
    return (
        bronze.withColumn("data", parsed)
        .filter("data.patient_id IS NULL")
        .select("event_id", "raw_json", "ingested_at", reason.alias("reason"))
    )


def wrong_type() -> Column:
    """Whether a field of a parsed event is NULL although its text (``raw_json``) has a value for it."""
    tests = [
        F.col(f.name).isNull() & F.get_json_object("raw_json", f"$.{f.name}").isNotNull()
        for f in schemas.EVENT
    ]
    return F.array_contains(F.array(*tests), True)


def dq_rules(as_of=None) -> dict[str, Column]:
    """Rule name to the predicate that marks a violating row of typed, unrepaired events."""
    admitted = F.col("admission_time")
    clamped = F.when(admitted <= now(as_of), admitted).otherwise(now(as_of))
    return {
        "missing_patient": F.col("patient_id").isNull(),
        "missing_admission": admitted.isNull(),
        "future_admission": admitted > now(as_of),
        "missing_discharge": F.col("discharge_time").isNull(),
        "negative_stay": F.col("discharge_time") < clamped,
        "dirty_age": F.col("age") > MAX_AGE,
        "missing_age": F.col("age").isNull(),
        "missing_department": F.col("department").isNull(),
        "missing_bed": F.col("bed_id").isNull(),
    }


def dq_counts(as_of=None) -> list[Column]:
    """The rows checked and the violations of each rule, as aggregates."""
    rules = dq_rules(as_of).items()
    return [
        F.count(F.lit(1)).alias("rows_checked"),
        *(F.count_if(test).alias(rule) for rule, test in rules),
    ]


def dq_profile(typed: DataFrame, as_of=None) -> DataFrame:
    """Violations per rule, in one scan: ``(rule, violations, rows_checked)``."""
    totals = typed.agg(*dq_counts(as_of))
    return totals.unpivot("rows_checked", list(dq_rules(as_of)), "rule", "violations")
