"""The jobs end to end, as they are submitted."""

import pytest
from conftest import CLOCK, bronze, event, rows

from wardstream import __main__ as jobs
from wardstream.operators import kpis
from wardstream.plans.gold import Gold
from wardstream.plans.parted import PartedGold
from wardstream.plans.publish import publish
from wardstream.plans.views import VIEW_NAMES
from wardstream.session import scratch_dir


def test_silver_gold_publish(spark, capsys):
    root = scratch_dir(spark, "jobs")
    db = "jobs_test"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/db'")
    gold_args = ["gold", "--silver", f"{root}/silver", "--path", f"{root}/gold"]

    def load(clock, first_id, *texts):
        bronze(spark, *texts).selectExpr(
            f"event_id + {first_id} AS event_id", "raw_json", "ingested_at"
        ).write.mode("append").parquet(f"{root}/bronze")
        jobs.main(
            ["silver", "--bronze", f"{root}/bronze", "--path", f"{root}/silver"]
            + ["--checkpoint", f"{root}/c", "--quarantine", f"{root}/bad", "--available-now"]
        )
        jobs.main([*gold_args, "--as-of", clock])
        jobs.main(["publish", "--path", f"{root}/gold", "--database", db])

    load(CLOCK, 0, event(patient_id="a"), event(patient_id="b", gender="Female"), "not json")
    assert "dim_patient=2" in capsys.readouterr().out
    assert spark.read.parquet(f"{root}/bad").count() == 1
    load("2024-01-11 00:00:00", 100, event(patient_id="a", age=31))

    gold = Gold(spark, f"{root}/gold")
    assert spark.table(f"{db}.dim_patient").count() == gold.patients.read().count() == 3
    for name in ("dim_patient", "dim_department", "fact_patient_flow"):
        stored = {
            "dim_patient": gold.patients,
            "dim_department": gold.departments,
            "fact_patient_flow": gold.fact,
        }[name].read()
        assert rows(spark.table(f"{db}.{name}"), *stored.columns) == rows(stored)
    for kpi, view in VIEW_NAMES.items():
        assert rows(spark.table(f"{db}.{view}")) == rows(kpis.KPIS[kpi](gold.star()))
    one_day = spark.table(f"{db}.fact_patient_flow").filter("admission_date = '2024-01-08'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(admission_date" in plan
    assert one_day.count() == 2
    # Publishing again changes nothing.
    publish(gold, db)
    assert spark.table(f"{db}.dim_patient").count() == 3
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_gold_stream_job(spark):
    root = scratch_dir(spark, "jobs")
    bronze(spark, event(patient_id="a")).write.parquet(f"{root}/bronze")
    common = ["--checkpoint", f"{root}/c", "--available-now"]
    jobs.main(["silver", "--bronze", f"{root}/bronze", "--path", f"{root}/silver", *common])
    gold_args = ["gold", "--silver", f"{root}/silver", "--path", f"{root}/gold", "--stream"]
    with pytest.raises(SystemExit, match="checkpoint"):
        jobs.main(gold_args)
    jobs.main([*gold_args, "--checkpoint", f"{root}/c2", "--available-now", "--hashed-keys"])
    assert rows(Gold(spark, f"{root}/gold").fact.read(), "fact_id") == [(1,)]


def test_gold_by_parts_jobs(spark, capsys):
    """The gold stream by parts, its latest encounters in the stream's state, and its names in the catalogue."""
    root = scratch_dir(spark, "jobs")
    db = "jobs_parts_test"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/db'")
    gold_args = ["gold", "--silver", f"{root}/silver", "--path", f"{root}/gold", "--by-parts"]

    def load(first_id, *texts):
        rows_ = bronze(spark, *texts).selectExpr(f"event_id + {first_id} AS event_id", "raw_json", "ingested_at")
        rows_.write.mode("append").parquet(f"{root}/bronze")
        common = ["--checkpoint", f"{root}/c", "--available-now"]
        jobs.main(["silver", "--bronze", f"{root}/bronze", "--path", f"{root}/silver", *common])
        jobs.main([*gold_args, "--stream", "--checkpoint", f"{root}/c2", "--available-now", "--as-of", CLOCK])
        jobs.main(["publish", "--by-parts", "--path", f"{root}/gold", "--database", db])

    load(0, event(patient_id="a"), event(patient_id="b", gender="Female"))
    load(100, event(patient_id="a", age=31))
    gold = PartedGold(spark, f"{root}/gold")
    assert spark.table(f"{db}.dim_patient").count() == 3 and gold.state().free_key > 3
    for kpi, view in VIEW_NAMES.items():
        assert rows(spark.table(f"{db}.{view}")) == rows(kpis.KPIS[kpi](gold.star()))
    spark.sql(f"DROP DATABASE {db} CASCADE")
    # The same tables by single refreshes.
    jobs.main([*gold_args[:4], f"{root}/gold2", "--by-parts", "--as-of", CLOCK])
    assert "parts=1" in capsys.readouterr().out
    assert PartedGold(spark, f"{root}/gold2").fact().count() == 2
