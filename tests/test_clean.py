import pytest
from conftest import CLOCK, bronze, event, rows, silver, t
from pyspark.sql import Observation
from pyspark.sql import functions as F

from wardstream import schemas
from wardstream.functions.clock import now, parse_time
from wardstream.functions.keys import natural_key
from wardstream.operators import clean, synth
from wardstream.operators.fact import fact_patient_flow
from wardstream.operators.scd2 import attr_fingerprint


def cleaned(spark, *texts):
    return clean.clean_events(bronze(spark, *texts), CLOCK)


def one(spark, **changes):
    return cleaned(spark, event(**changes)).first()


def fact_of(spark, **changes):
    rows_ = cleaned(spark, event(**changes))
    nothing = spark.createDataFrame([], schemas.DIM_PATIENT)
    return fact_patient_flow(
        rows_, nothing, spark.createDataFrame([], schemas.DIM_DEPARTMENT), CLOCK
    ).first()


def test_plain_event(spark):
    row = one(spark)
    assert row.admission_time == t("2024-01-08 00:00:00")
    assert (row.patient_id, row.age, row.bed_id, row.hospital_id) == ("p", 30, 5, 1)
    fact = fact_of(spark)
    assert fact.length_of_stay_hours == 36.0 and fact.is_currently_admitted is False
    assert fact.patient_sk is None and fact.department_sk is None


def test_dirty_age_is_replaced_the_same_way_each_time(spark):
    ages = [one(spark, age=150).age for _ in range(2)]
    assert ages[0] == ages[1] and 1 <= ages[0] <= 90


def test_imputed_ages_cover_1_to_90(spark):
    df = spark.range(1000).select(F.col("id").alias("event_id"), F.lit(101).alias("age"))
    span = clean.impute_age(df).agg(F.min("age"), F.max("age"), F.countDistinct("age")).first()
    assert tuple(span) == (1, 90, 90)


@pytest.mark.parametrize("age", [100, -3, None])
def test_other_ages_pass(spark, age):
    assert one(spark, age=age).age == age


@pytest.mark.parametrize("age", ["xx", 5.7, 99999999999])
def test_unreadable_age_spoils_only_itself(spark, age):
    row = one(spark, age=age)
    assert row.age is None and row.patient_id == "p" and row.bed_id == 5


def test_future_admission_is_clamped_and_stay_may_be_negative(spark):
    fact = fact_of(
        spark, admission_time="2024-01-12T00:00:00", discharge_time="2024-01-09T06:00:00"
    )
    assert fact.admission_time == t(CLOCK)
    assert fact.length_of_stay_hours == -18.0 and fact.is_currently_admitted is False


@pytest.mark.parametrize("text", [..., None, "garbage", "12:30", "12:30Z"])
def test_unusable_admission_becomes_the_clock(spark, text):
    assert one(spark, admission_time=text).admission_time == t(CLOCK)


def test_admission_at_the_clock_stays(spark):
    assert one(spark, admission_time="2024-01-10T00:00:00").admission_time == t(CLOCK)


def test_missing_discharge(spark):
    fact = fact_of(spark, discharge_time=...)
    assert fact.length_of_stay_hours is None and fact.is_currently_admitted is False


@pytest.mark.parametrize(
    ("discharge", "admitted"), [("2024-01-10T00:00:00", False), ("2024-01-10T00:00:01", True)]
)
def test_admitted_until_discharge(spark, discharge, admitted):
    assert fact_of(spark, discharge_time=discharge).is_currently_admitted is admitted


def test_stay_counts_whole_seconds(spark):
    fact = fact_of(
        spark,
        admission_time="2024-01-08T00:00:00.900000",
        discharge_time="2024-01-08T01:00:00.100000",
    )
    assert fact.length_of_stay_hours == 1.0


def test_unreadable_text_is_quarantined(spark):
    df = cleaned(spark, "not json", "", None, event())
    assert [r.event_id for r in clean.accepted(df).collect()] == [4]
    held = clean.quarantine(df).orderBy("event_id").collect()
    assert [r.event_id for r in held] == [1, 2, 3]
    assert {r.reason for r in held} == {"missing patient_id"}


def test_rejected_text_is_kept_with_a_reason(spark):
    df = bronze(
        spark, "not json", "", None, event(), event(patient_id=...), event(age="xx"), "{", "[]"
    )
    got = {r.event_id: (r.raw_json, r.reason) for r in clean.rejected_input(df).collect()}
    assert {k: v[1] for k, v in got.items()} == {
        1: "unreadable",
        2: "empty",
        3: "empty",
        5: "missing patient_id",
        7: "unreadable",
        8: got[8][1],
    }
    assert got[1][0] == "not json"
    # Exactly the rows the clean table quarantines.
    assert rows(clean.quarantine(clean.clean_events(df, CLOCK)), "event_id") == [
        (k,) for k in sorted(got)
    ]


def test_dq_counts_are_observed_in_passing(spark):
    seen = Observation()
    df = clean.clean_events(bronze(spark, event(age=150), "not json"), CLOCK, seen)
    assert df.count() == 2
    assert seen.get["rows_checked"] == 2
    assert seen.get["dirty_age"] == 1 and seen.get["missing_patient"] == 1


def test_unknown_fields_are_dropped(spark):
    assert cleaned(spark, event(extra=1)).columns == schemas.SILVER.names


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_text_does_not_depend_on_the_session_zone(spark, zone):
    cases = {
        "2024-01-08T01:02:03": "2024-01-08 01:02:03",
        "2024-01-08T01:02:03.5": "2024-01-08 01:02:03.500000",
        "2024-01-08": "2024-01-08 00:00:00",
        "2024-01-08T01:00:00Z": "2024-01-08 01:00:00",
        "2024-01-08T01:00:00+02:00": "2024-01-07 23:00:00",
        "2024-01-08T01:00:00-0800": "2024-01-08 09:00:00",
        "2024-01-08T01:00:00 Europe/Berlin": "2024-01-08 00:00:00",
        "2024-13-08T00:00:00": None,
        "": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r.s: r.t for r in df.select("s", parse_time("s").alias("t")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {k: v and t(v) for k, v in cases.items()}


def test_clock_defaults_to_utc_now(spark):
    from datetime import UTC, datetime, timedelta, timezone

    zoned = datetime(2024, 1, 8, 1, tzinfo=timezone(timedelta(hours=2)))
    assert spark.range(1).select(now(zoned)).first()[0] == t("2024-01-07 23:00:00")
    value = spark.range(1).select(now()).first()[0]
    assert abs((value - datetime.now(UTC).replace(tzinfo=None)).total_seconds()) < 60


def test_conform_adds_typed_nulls_and_keeps_order(spark):
    df = spark.createDataFrame([("x", "7")], "department string, bed_id string")
    out = clean.conform_schema(df)
    assert out.schema.names == schemas.SILVER.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.SILVER]
    assert out.first().bed_id == 7 and out.first().admission_time is None


def test_bronze_packs_broker_position(spark):
    wire = spark.createDataFrame(
        [(b"a", 0, 5), (b"b", 3, 5)], "value binary, partition int, offset bigint"
    )
    got = clean.bronze_decode(wire, CLOCK).collect()
    assert [(r.event_id, r.raw_json) for r in got] == [(5, "a"), ((3 << 44) + 5, "b")]


def test_dq_profile_counts_each_rule(spark):
    typed = silver(
        spark,
        {"age": 120},
        {"patient_id": None, "age": None},
        {"admission_time": "2024-02-01 00:00:00"},
        {"discharge_time": "2024-01-07 00:00:00", "bed_id": None},
        {"discharge_time": None, "department": None, "admission_time": None},
    )
    got = {r.rule: r.violations for r in clean.dq_profile(typed, CLOCK).collect()}
    assert got == {
        "missing_patient": 1,
        "missing_admission": 1,
        "future_admission": 1,
        "missing_discharge": 1,
        "negative_stay": 2,
        "dirty_age": 1,
        "missing_age": 1,
        "missing_department": 1,
        "missing_bed": 1,
    }


def test_fingerprint_modes(spark):
    df = silver(spark, {"gender": None}, {"gender": "NA"})
    parity = {r.attr_hash for r in attr_fingerprint(df).collect()}
    strict = {r.attr_hash for r in attr_fingerprint(df, null_safe=True).collect()}
    assert len(parity) == 1 and len(strict) == 2


def test_natural_key_is_unambiguous(spark):
    pairs = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None)]
    pairs += [("-", "-"), (None, None)]
    df = spark.createDataFrame(pairs, "x string, y string")
    assert df.select(natural_key("x", "y")).distinct().count() == len(pairs)


def test_synth_domains_rates_and_replay(spark):
    ids = spark.range(20000).select(F.col("id").alias("event_id"))
    df = synth.synth_events(ids, seed=1, as_of=CLOCK)
    assert df.exceptAll(synth.synth_events(ids, seed=1, as_of=CLOCK)).isEmpty()
    s = df.agg(
        F.avg((F.col("age") > 100).cast("int")).alias("old"),
        F.avg((F.col("admission_time") > now(CLOCK)).cast("int")).alias("ahead"),
        F.min("age").alias("lo"),
        F.max("age").alias("hi"),
        F.countDistinct("patient_id").alias("patients"),
        F.countDistinct("department").alias("departments"),
        F.countDistinct("hospital_id").alias("hospitals"),
        F.min("bed_id").alias("bed_lo"),
        F.max("bed_id").alias("bed_hi"),
    ).first()
    assert 0.04 < s.old < 0.06 and 0.04 < s.ahead < 0.06
    assert (s.lo, s.hi, s.bed_lo, s.bed_hi) == (1, 150, 1, 500)
    assert (s.patients, s.departments, s.hospitals) == (20000, 7, 7)
    assert sorted(df.columns) == sorted(schemas.SILVER.names)
