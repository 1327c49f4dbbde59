"""Redelivery without a watermark, quality logs, bucketed and parted publishing, beds as bitmaps."""

import re

import pytest
from conftest import CLOCK, SF, event, rows, silver, t

from wardstream import schemas
from wardstream.operators import clean, kpis
from wardstream.plans import views
from wardstream.plans.gold import build_star
from wardstream.plans.parted import PartedGold
from wardstream.plans.publish import catalogue_star, publish_bucketed, publish_parts
from wardstream.plans.registry import silver_rows
from wardstream.session import scratch_dir
from wardstream.sources.tables import matching_paths, remove_path, table_stream
from wardstream.streaming import ingest, once, quality

AS_OF = "2024-01-30 20:00:00"


@pytest.fixture
def base(spark):
    return scratch_dir(spark, "test-r3")


@pytest.fixture
def no_broadcast(spark):
    names = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = [spark.conf.get(c, None) for c in names]
    for c in names:
        spark.conf.set(c, "-1")
    yield
    for c, v in zip(names, before, strict=True):
        spark.conf.unset(c) if v is None else spark.conf.set(c, v)


# Each event once.


def deliver(spark, base, *records):
    silver(spark, *records).coalesce(1).write.mode("append").parquet(f"{base}/in")


def run_once(spark, base, checkpoint="cp"):
    stream = table_stream(spark, f"{base}/in", schemas.SILVER, max_files_per_trigger=1)
    once.start_once(stream, f"{base}/out", f"{base}/{checkpoint}", available_now=True).awaitTermination()
    return rows(once.read_once(spark, f"{base}/out", schemas.SILVER), "event_id", "arrived_at", "bed_id")


def at(i, day, arrived, **more):
    return {"event_id": i, "admission_time": t(f"2024-01-{day:02d} 01:00:00"), "arrived_at": t(arrived), **more}


def test_an_event_delivered_again_after_thirty_days(spark, base):
    first, late = "2024-01-08 00:00:00", "2024-02-08 00:00:00"
    deliver(spark, base, at(1, 5, first), at(2, 6, first), at(2, 6, first, bed_id=9), at(None, 5, first), {**at(4, 5, first), "admission_time": None})
    want = [(1, t(first)), (2, t(first)), (4, t(first)), (None, t(first))]
    assert [r[:2] for r in run_once(spark, base)] == sorted(want, key=repr)
    deliver(spark, base, at(1, 5, late), at(3, 5, late), at(None, 5, late), {**at(4, 5, late), "admission_time": None})
    want += [(3, t(late)), (None, t(late))]
    got = run_once(spark, base)
    assert [r[:2] for r in got] == sorted(want, key=repr)
    # A batch replayed after a crash is not compared with itself.
    for p in matching_paths(spark, f"{base}/cp/commits/*1"):
        remove_path(spark, p)
    assert run_once(spark, base) == got
    with pytest.raises(ValueError, match="another checkpoint"):
        run_once(spark, base, "other")


def test_only_the_days_of_a_batch_are_read(spark, base):
    deliver(spark, base, *(at(i, 1 + i % 9, "2024-01-10 00:00:00") for i in range(90)))
    run_once(spark, base)
    days = [t("2024-01-03 00:00:00").date(), None]
    keys = once.stored_keys(spark, f"{base}/out", schemas.SILVER["event_id"], days, 7)
    assert keys.count() == 10
    assert keys.inputFiles() and all("/event_day=2024-01-03/" in f for f in keys.inputFiles())
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint>" in plan
    assert once.stored_keys(spark, f"{base}/out", schemas.SILVER["event_id"], days, 0).isEmpty()


# Quality.


def test_quality_over_batches_and_a_restart(spark, base):
    texts = [event(), event(age=130), event(age="old"), "not json", event(patient_id=None), event(bed_id=None), event(admission_time="2030-01-01T00:00:00")]
    log = quality.QualityLog(spark, f"{base}/quality")

    def run(first, *some):
        data = [(first + i, x, t(CLOCK)) for i, x in enumerate(some)]
        spark.createDataFrame(data, schemas.BRONZE).coalesce(1).write.mode("append").parquet(f"{base}/bronze")
        stream = table_stream(spark, f"{base}/bronze", schemas.BRONZE, max_files_per_trigger=1)
        query = ingest.start_silver(stream, f"{base}/silver", f"{base}/cp", CLOCK, dq="dq", available_now=True)
        query.awaitTermination()
        log.wait(query)

    with log:
        run(0, *texts[:3])
        run(3, *texts[3:5])
        run(5, *texts[5:])
        # Run again after a crash before its commit: logged twice, counted once.
        for p in matching_paths(spark, f"{base}/cp/commits/*2"):
            remove_path(spark, p)
        log.logged.clear()
        run(9)
    assert quality.batches(spark, f"{base}/quality").count() == 3
    assert spark.read.parquet(f"{base}/quality").count() >= 3
    assert quality.missing_batches(spark, f"{base}/quality").isEmpty()
    typed = clean.type_times(clean.parse_events(spark.read.schema(schemas.BRONZE).parquet(f"{base}/bronze")))
    want = {r.rule: (r.violations, r.rows_checked) for r in clean.dq_profile(typed, CLOCK).collect()}
    got = {r.rule: (r.violations, r.rows_checked) for r in quality.profile(spark, f"{base}/quality").collect()}
    assert got.pop("wrong_type") == (1, 7) and got == want


def test_missing_batches_are_named(spark, base):
    log = [("q", b, f"2024-01-0{b + 1}", {"rows_checked": 2, "dirty_age": 1}) for b in (0, 1, 4)] + [("q", 1, "2024-01-09", {"rows_checked": 3, "dirty_age": 0})]
    spark.createDataFrame(log, quality._LOG).write.parquet(base)
    assert rows(quality.missing_batches(spark, base)) == [("q", 2), ("q", 3)]
    assert rows(quality.profile(spark, base), "rule", "violations", "rows_checked") == [("dirty_age", 2, 7)]


# Publishing.


def test_reports_on_buckets_exchange_no_facts(spark, base, no_broadcast):
    spark.sql(f"CREATE DATABASE bucket_test LOCATION '{base}/db'")
    star = build_star(silver_rows(spark, SF), AS_OF, "visit")
    made = publish_bucketed(star, "bucket_test", 4)
    stored = catalogue_star(spark, "bucket_test", "visit")
    for name in ("patient_demographics", "department_inflow", "bed_turnover_rate"):
        report, view = kpis.KPIS[name](stored), spark.table(f"bucket_test.{views.VIEW_NAMES[name]}")
        assert rows(view) == rows(report) == rows(kpis.KPIS[name](star))
        plan = report._jdf.queryExecution().executedPlan().toString()
        # What is exchanged has been grouped by the report's keys, or is the departments.
        exchanged = re.findall(r"Exchange hashpartitioning\(([a-z_]+)", plan)
        assert "SortMergeJoin" in plan and exchanged and "patient_sk" not in exchanged
    assert len(made) == 3 * len(views.VIEW_NAMES)
    publish_bucketed(star, "bucket_test", 4, version=2)
    held = {x.name for x in spark.catalog.listTables("bucket_test") if not x.isTemporary and "_v" in x.name}
    assert held == {"dim_patient_v2", "dim_department_v2", "fact_patient_flow_v2"}
    spark.sql("DROP DATABASE bucket_test CASCADE")


def test_parts_are_published_as_of_one_refresh(spark, base):
    spark.sql(f"CREATE DATABASE parts_test LOCATION '{base}/db'")
    gold = PartedGold(spark, f"{base}/gold", parts=2, split_rows=8, key_block=10)
    with pytest.raises(FileNotFoundError):
        publish_parts(gold, "parts_test")
    sizes = []
    for day in (8, 9, 10):
        clock = f"2024-01-{day:02d} 12:00:00"
        gold.refresh(silver(spark, *({"event_id": 100 * day + i, "patient_id": f"p{i}", "age": day if i < 3 else 30, "admission_time": f"2024-01-{day:02d} 00:00:00", "discharge_time": "2024-01-09 18:00:00"} for i in range(20))), clock)
        publish_parts(gold, "parts_test")
        star = catalogue_star(spark, "parts_test")
        for name in ("fact", "patients", "departments"):
            assert rows(getattr(star, name)) == rows(getattr(gold.star(), name))
        assert rows(spark.table("parts_test.vw_department_inflow")) == rows(kpis.department_inflow(gold.star()))
        sizes.append(len([x for x in spark.catalog.listTables("parts_test") if not x.isTemporary]))
    assert len(set(sizes)) == 1
    # Without rows only the clock moves.
    gold.refresh(silver(spark, {}).filter("false"), "2024-01-08 13:00:00")
    publish_parts(gold, "parts_test")
    assert spark.table("parts_test.fact_patient_flow").filter("is_currently_admitted").count() == 20
    spark.sql("DROP DATABASE parts_test CASCADE")


# Beds.


def test_beds_are_exchanged_as_bitmaps(spark, base, no_broadcast):
    star = build_star(silver_rows(spark, SF), AS_OF, "visit")
    report = kpis.bed_turnover_rate(star)
    plan = report._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    after = [re.sub(r"#\d+L?", "", k) for k in keys if "patient" not in k and "department" not in k]
    assert sorted(after) == ["gender", "gender, beds_from"] and "bitmap_construct_agg" in plan
    assert "bed_id" not in "".join(keys)


def test_beds_of_any_number(spark):
    facts = [(i, 1, b) for i, b in enumerate([5, 5, 32768, 32769, 1, 10**9, None, None, -7])] + [(90, 2, None), (91, 3, 4)]
    fact = spark.createDataFrame(facts, "fact_id long, patient_sk long, bed_id int")
    patients = spark.createDataFrame([(1, "Male"), (2, "Female"), (3, None)], "surrogate_key long, gender string")
    star = kpis.Star(fact, patients, spark.createDataFrame([], schemas.DIM_DEPARTMENT), "visit")
    assert rows(kpis.bed_turnover_rate(star)) == sorted([("Male", 9 / 6), ("Female", None), (None, 1.0)], key=repr)
    assert rows(kpis.bed_turnover_rate(star, "Male")) == [("Male", 1.5)]
    assert kpis.bed_turnover_rate(kpis.Star(fact.limit(0), patients, star.departments)).isEmpty()
