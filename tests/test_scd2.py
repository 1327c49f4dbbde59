import random

import pytest
from conftest import rows, silver, t
from pyspark.sql import functions as F

from wardstream import schemas
from wardstream.operators import scd2
from wardstream.operators.keys import dense_keys, duplicate_keys
from wardstream.operators.latest import latest_by_key, latest_encounter
from wardstream.session import materialise

DAYS = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]
INPUTS = [
    [("a", "M", 1), ("b", "F", 2), ("c", None, None)],
    [("a", "M", 9), ("b", "F", 2), ("d", "F", 4)],
    [("a", "M", 9), ("b", "F", 2), ("d", "F", 4)],
]


def incoming(spark, data):
    return spark.createDataFrame(data, "patient_id string, gender string, age int")


def run(spark, inputs, days, null_safe=False):
    dim = materialise(scd2.scd2_init(incoming(spark, inputs[0]), days[0]), "dim")
    for data, day in zip(inputs[1:], days[1:]):
        dim = materialise(scd2.scd2_apply(dim, incoming(spark, data), day, null_safe), "dim")
    return dim


def check_invariants(dim):
    assert duplicate_keys(dim).isEmpty()
    by_patient = {}
    for r in dim.collect():
        by_patient.setdefault(r.patient_id, []).append(r)
    for versions in by_patient.values():
        versions.sort(key=lambda r: r.effective_from)
        assert [r.is_current for r in versions] == [False] * (len(versions) - 1) + [True]
        for old, new in zip(versions, versions[1:]):
            assert old.effective_to == new.effective_from
        assert versions[-1].effective_to is None


SHOW = ["patient_id", "age", "effective_from", "effective_to", "is_current"]


def test_three_days(spark):
    first = run(spark, INPUTS[:1], DAYS)
    assert first.count() == 3 and first.columns == schemas.DIM_PATIENT.names
    second = run(spark, INPUTS[:2], DAYS)
    d1, d2 = t(DAYS[0]), t(DAYS[1])
    assert rows(second, *SHOW) == sorted(
        [
            ("a", 1, d1, d2, False),
            ("a", 9, d2, None, True),
            ("b", 2, d1, None, True),
            ("c", None, d1, None, True),
            ("d", 4, d2, None, True),
        ],
        key=repr,
    )
    third = run(spark, INPUTS, DAYS)
    assert rows(third) == rows(second)
    check_invariants(third)


def test_steps_add_up_to_apply(spark):
    dim = run(spark, INPUTS[:1], DAYS)
    new = incoming(spark, INPUTS[1])
    assert rows(scd2.scd2_new_keys(dim, new), "patient_id") == [("d",)]
    assert rows(scd2.scd2_changes(dim, new), "patient_id") == [("a",)]
    closed = scd2.scd2_close(dim, new, DAYS[1])
    opened = scd2.scd2_inserts(dim, new, DAYS[1])
    assert rows(closed, "patient_id", "is_current") == [("a", False)]
    assert rows(opened, "patient_id") == [("a",), ("d",)]
    untouched = dim.join(closed, "surrogate_key", "left_anti").select(*dim.columns)
    stepwise = untouched.unionByName(closed).unionByName(opened)
    assert rows(stepwise) == rows(scd2.scd2_apply(dim, new, DAYS[1]))


def test_null_patient_never_enters(spark):
    data = [(None, "M", 1), ("a", "M", 1)]
    dim = run(spark, [data, data, data], DAYS)
    assert rows(dim, "patient_id") == [("a",)]


def test_null_and_na_text(spark):
    steps = [[("a", None, 1)], [("a", "NA", 1)]]
    assert run(spark, steps, DAYS).count() == 1
    assert run(spark, steps, DAYS, null_safe=True).count() == 2


@pytest.mark.parametrize("seed", range(3))
def test_random_loads(spark, seed):
    rng = random.Random(seed)
    days = [f"2024-01-0{d} 00:00:00" for d in range(1, 6)]
    loads = [
        [
            (f"p{i}", rng.choice(["M", "F", None]), rng.choice([None, 1, 2]))
            for i in range(12)
            if rng.random() < 0.7
        ]
        for _ in days
    ]
    dim = run(spark, loads, days)
    check_invariants(dim)
    # Brute force: replay one patient at a time.
    expected = []
    for p in sorted({r[0] for load in loads for r in load}):
        versions = []
        for day, load in zip(days, loads):
            for _, gender, age in (r for r in load if r[0] == p):
                if not versions or versions[-1][1:3] != (gender, age):
                    versions.append((p, gender, age, t(day)))
        ends = [v[3] for v in versions[1:]] + [None]
        expected += [(*v, end, end is None) for v, end in zip(versions, ends)]
    cols = ["patient_id", "gender", "age", "effective_from", "effective_to", "is_current"]
    assert rows(dim, *cols) == sorted(expected, key=repr)
    # The back-fill over all loads at once gives the same dimension, keys included.
    batches = [
        (i, p, g, a, t(day), t(day))
        for i, (day, load) in enumerate(zip(days, loads))
        for p, g, a in load
    ]
    frame = spark.createDataFrame(
        batches,
        "event_id bigint, patient_id string, gender string, age int,"
        " admission_time timestamp_ntz, batch_time timestamp_ntz",
    )
    assert rows(scd2.scd2_history(frame), *dim.columns) == rows(dim)


def test_latest_prefers_the_later_event_on_ties(spark):
    df = silver(spark, {"age": 1}, {"age": 2}, {"patient_id": "q"})
    assert rows(latest_encounter(df), "patient_id", "event_id") == [("p", 2), ("q", 3)]


def test_latest_by_composite_key(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 1, 7), (1, 2, 1)], "a int, b int, c int")
    assert rows(latest_by_key(df, ["a", "b"], ["c"])) == [(1, 1, 7), (1, 2, 1)]


@pytest.mark.parametrize("partitions", ["1", "13"])
def test_dense_keys_depend_only_on_the_data(spark, partitions):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = [tuple(r) for r in dense_keys(df, ["k"], start=100).orderBy("k").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [key for _, key in got] == list(range(101, 5101))


def test_dense_keys_of_nothing(spark):
    assert dense_keys(spark.range(0), ["id"]).count() == 0
