"""Plans that must hold at scale."""

import re

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from wardstream.operators import fact as facts
from wardstream.operators import kpis, scd2
from wardstream.operators.dims import dim_department
from wardstream.operators.latest import latest_encounter
from wardstream.plans.gold import build_star
from wardstream.plans.registry import QUERIES, silver_rows, star, usable
from wardstream.session import materialise, scratch_dir


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


def test_latest_is_limited_before_the_shuffle(spark):
    text = plan(latest_encounter(usable(spark, SF)))
    order = [m for m in re.findall(r"WindowGroupLimit.*?(Partial|Final)|(Exchange)", text)]
    assert [a or b for a, b in order] == ["Final", "Exchange", "Partial"]


def test_cleaning_never_shuffles(spark):
    for name in ("bronze_decode", "parse_events", "silver", "quarantine"):
        assert "Exchange" not in plan(QUERIES[name](spark, SF)), name


def test_no_python_workers(spark):
    for name, query in QUERIES.items():
        if not name.startswith("stream_"):
            text = plan(query(spark, SF))
            assert "Python" not in text and "CartesianProduct" not in text, name
            assert "BroadcastNestedLoopJoin" not in text, name


def test_kpis_read_only_their_columns(spark, tmp_path):
    s = star(spark, SF)
    s.fact.write.parquet(f"{tmp_path}/fact")
    stored = kpis.Star(spark.read.parquet(f"{tmp_path}/fact"), s.patients, s.departments)
    text = plan(kpis.overstay_patients(stored))
    fact_scan = next(c for c in scans(text) if "patient_sk" in c)
    assert set(re.findall(r"(\w+):", fact_scan)) == {
        "patient_sk",
        "department_sk",
        "length_of_stay_hours",
    }
    assert "GreaterThan(length_of_stay_hours,50.0)" in text


def test_history_is_not_shuffled_by_apply(spark):
    s = star(spark, SF)
    incoming = scd2.incoming_patients(latest_encounter(usable(spark, SF)))
    stored = materialise(s.patients, "dim")
    text = plan(scd2.scd2_apply(stored, incoming, "2024-02-01 00:00:00"))
    history = text.split("Generate")[0]
    assert "Exchange" not in history and "NOT is_current" in history


@pytest.fixture
def no_broadcast(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_patient_is_split_and_results_stay_whole(spark, no_broadcast):
    """Dimensions too large to broadcast, one patient with a third of all visits."""
    base = silver_rows(spark, SF.replace("0.001", "0.01"))
    # 16 map tasks, so that the hot partition has blocks to be split by.
    hot = base.withColumn(
        "patient_id",
        F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("event_id").cast("string")),
    ).repartition(16)
    s = build_star(hot, "2024-01-30 20:00:00", "visit")
    got = rows(s.fact, "fact_id", "patient_sk")
    assert len(got) == hot.count()
    s.fact.write.format("noop").mode("overwrite").save()
    df = s.fact
    df.collect()
    assert "skewed" in plan(df)
    assert len({sk for fact_id, sk in got if fact_id % 3 == 0}) == 1
    assert None not in {sk for _, sk in got}


def test_hot_date_is_written_by_many_tasks(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400k")
    fact = star(spark, SF.replace("0.001", "0.1"), "visit").fact
    date = F.when(F.col("fact_id") % 3 == 0, F.to_date(F.lit("2024-02-01")))
    hot = fact.withColumn("admission_date", F.coalesce(date, "admission_date"))
    path = scratch_dir(spark, "hot-date")
    facts.write_fact_by_date(hot, path)
    files = facts.read_fact(spark, path).select("admission_date", F.input_file_name().alias("f"))
    per_date = {
        str(r.admission_date): r.n
        for r in files.groupBy("admission_date").agg(F.countDistinct("f").alias("n")).collect()
    }
    # Dates that share the hot one's partition are split with it; the others are not.
    assert per_date["2024-02-01"] >= 3 and min(per_date.values()) == 1
    assert files.count() == fact.count()


def test_department_lookup_needs_no_fact_shuffle(spark):
    rows_ = usable(spark, SF)
    s = build_star(silver_rows(spark, SF))
    text = plan(facts.fact_patient_flow(rows_, s.patients, s.departments))
    assert text.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in text


def test_department_dimension_combines_before_the_shuffle(spark):
    text = plan(dim_department(usable(spark, SF)))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1
