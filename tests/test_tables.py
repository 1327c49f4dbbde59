import pytest
from conftest import CLOCK, SF, rounded, rows, silver, t
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wardstream import schemas
from wardstream.operators import fact as facts
from wardstream.plans import views
from wardstream.plans.gold import Gold, build_star, table_counts
from wardstream.plans.registry import silver_rows, star
from wardstream.session import scratch_dir
from wardstream.sources.broker import broker_options, broker_stream
from wardstream.sources.snapshot import SnapshotTable
from wardstream.sources.tables import create_external_table, repoint_table

AS_OF = "2024-01-30 20:00:00"


@pytest.fixture
def base(spark):
    return scratch_dir(spark, "test")


def departments(spark, *names):
    data = [(i, n, 1) for i, n in enumerate(names)]
    return spark.createDataFrame(data, schemas.DIM_DEPARTMENT)


def test_snapshot_replace_append_and_self_read(spark, base):
    table = SnapshotTable(spark, base, schemas.DIM_DEPARTMENT)
    assert not table.exists() and table.version() == 0
    assert table.replace(departments(spark, "a")) == 1
    shuffled = departments(spark, "b", "c").select("hospital_id", "department", "surrogate_key")
    assert table.append(shuffled) == 3
    assert rows(table.read(), "department") == [("a",), ("b",), ("c",)]
    # A table may be replaced by a query over itself.
    assert table.replace(table.read().filter("department <> 'b'")) == 2
    assert rows(table.read(), "department") == [("a",), ("c",)]
    assert table.version() == 3
    assert table.replace(table.read().filter("false")) == 0
    assert table.read().isEmpty()


def test_unfinished_version_is_invisible_and_overwritten(spark, base):
    table = SnapshotTable(spark, base, schemas.DIM_DEPARTMENT)
    table.replace(departments(spark, "a"))
    # What a run leaves behind that died before its job was complete: files, but no marker.
    unmarked = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    departments(spark, "x", "y").write.options(**unmarked).parquet(table.folder(2))
    assert table.version() == 1 and rows(table.read(), "department") == [("a",)]
    table.replace(departments(spark, "b"))
    assert table.version() == 2 and rows(table.read(), "department") == [("b",)]


def patients(spark, *versions):
    data = [
        (p, "M", 1, t(CLOCK), k, None if current else t(CLOCK), current)
        for k, p, current in versions
    ]
    return spark.createDataFrame(data, schemas.DIM_PATIENT)


def test_closed_rows_are_written_once(spark, base):
    table = SnapshotTable(spark, base, schemas.DIM_PATIENT, open_column="is_current")
    table.replace(patients(spark, (1, "a", True), (2, "b", True)))
    table.replace(patients(spark, (1, "a", False), (3, "a", True), (2, "b", True)))
    table.replace(patients(spark, (3, "a", False), (4, "a", True), (2, "b", True)))
    assert rows(table.read(), "surrogate_key", "is_current") == [
        (1, False),
        (2, True),
        (3, False),
        (4, True),
    ]
    written = spark.read.parquet(f"{base}/v=3/is_current=false")
    assert rows(written, "surrogate_key") == [(3,)]
    table.append(patients(spark, (9, "z", True)))
    assert table.read().count() == 5
    # No open row and no closed row at all.
    empty = SnapshotTable(spark, f"{base}-none", schemas.DIM_PATIENT, open_column="is_current")
    empty.replace(patients(spark).filter("false"))
    assert empty.read().isEmpty() and empty.read().columns == schemas.DIM_PATIENT.names


@pytest.mark.parametrize("dense", [True, False])
def test_gold_in_steps_equals_gold_at_once(spark, base, dense):
    data = silver_rows(spark, SF)
    cuts = ["2024-01-10 00:00:00", "2024-01-20 00:00:00", AS_OF]
    step = Gold(spark, f"{base}/step", dense_keys=dense)
    before = None
    for cut in cuts:
        until = F.lit(cut).cast("timestamp_ntz")
        part = F.col("admission_time") <= until
        if before is not None:
            part &= F.col("admission_time") > before
        step.refresh(data.filter(part), cut)
        before = until
    whole = Gold(spark, f"{base}/whole", dense_keys=dense)
    written = whole.refresh(data, AS_OF)
    assert written == {
        "latest": 15,
        "dim_patient": 15,
        "dim_department": written["dim_department"],
        "fact_patient_flow": 15,
    }
    step.check_keys()
    plain = [c for c in schemas.FACT.names if c != "patient_sk"]
    assert rows(step.fact.read(), *plain) == rows(whole.fact.read(), *plain)
    current = ["patient_id", "gender", "age"]
    assert rows(step.patients.read().filter("is_current"), *current) == rows(
        whole.patients.read(), *current
    )
    counts = {r.table_name: r.row_count for r in step.counts().collect()}
    assert counts["fact_patient_flow"] == 15 and counts["dim_patient"] > 15
    # Every fact meets exactly one patient version.
    star_ = step.star()
    joined = star_.fact.join(star_.patients, F.col("patient_sk") == F.col("surrogate_key"))
    assert joined.count() == 15


def test_repeating_a_refresh_changes_nothing(spark, base):
    gold = Gold(spark, base)
    rows_ = silver(spark, {"patient_id": "a"}, {"patient_id": "b"})
    gold.refresh(rows_, CLOCK)
    dims_before, fact_before = rows(gold.patients.read()), rows(gold.fact.read())
    gold.refresh(rows_, CLOCK)
    gold.refresh(rows_.filter("false"), CLOCK)
    assert rows(gold.patients.read()) == dims_before
    assert rows(gold.fact.read()) == fact_before


def test_interrupted_refresh_is_finished_by_its_replay(spark, base, monkeypatch):
    gold, straight = Gold(spark, f"{base}/a"), Gold(spark, f"{base}/b")
    first = silver(spark, {"patient_id": "a", "age": 1})
    second = silver(
        spark,
        {"event_id": 7, "patient_id": "a", "age": 2},
        {"event_id": 8, "patient_id": "b"},
    )
    for g in (gold, straight):
        g.refresh(first, CLOCK)
    with monkeypatch.context() as m:
        m.setattr(gold.departments, "replace", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            gold.refresh(second, "2024-01-11 00:00:00")
    for g in (gold, straight):
        g.refresh(second, "2024-01-11 00:00:00")
    assert rows(gold.patients.read()) == rows(straight.patients.read())
    assert rows(gold.fact.read()) == rows(straight.fact.read())


def test_absent_patients_stay(spark, base):
    gold = Gold(spark, base)
    gold.refresh(silver(spark, {"patient_id": "a"}), CLOCK)
    gold.refresh(silver(spark, {"event_id": 9, "patient_id": "b"}), CLOCK)
    assert rows(gold.patients.read(), "patient_id", "is_current") == [("a", True), ("b", True)]


def test_check_keys_reports_duplicates(spark, base):
    gold = Gold(spark, base)
    gold.refresh(silver(spark, {"patient_id": "a"}), CLOCK)
    gold.patients.append(gold.patients.read())
    with pytest.raises(ValueError, match="dim_patient.surrogate_key"):
        gold.check_keys()


def test_fact_by_date_overwrites_only_the_dates_given(spark, base):
    s = build_star(
        silver(
            spark,
            {"patient_id": "a"},
            {"patient_id": "b", "admission_time": "2024-01-07 00:00:00"},
        ),
        CLOCK,
    )
    facts.write_fact_by_date(s.fact, base)
    changed = s.fact.filter("fact_id = 2").withColumn("bed_id", F.lit(77))
    facts.write_fact_by_date(changed, base)
    got = facts.read_fact(spark, base)
    assert got.columns == schemas.FACT.names
    assert rows(got, "fact_id", "bed_id") == [(1, 5), (2, 77)]
    plan = got.filter("admission_date = DATE '2024-01-07'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(admission_date" in text
    assert rows(plan, "fact_id") == [(2,)]


def test_external_tables_and_lasting_views(spark, base):
    s = star(spark, SF)
    tables = {
        "dim_patient": (s.patients, schemas.DIM_PATIENT),
        "dim_department": (s.departments, schemas.DIM_DEPARTMENT),
        "fact_patient_flow": (s.fact, schemas.FACT),
    }
    for name, (df, schema) in tables.items():
        df.write.parquet(f"{base}/{name}")
        table = create_external_table(spark, f"x_{name}", schema, f"{base}/{name}")
        assert table.dtypes == df.select(*schema.names).dtypes
        assert rows(table) == rows(df.select(*schema.names))
    named = {n: f"x_{n}" for n in tables}
    made = views.create_views(spark, named, prefix="x_")
    for kpi, view in zip(views.VIEW_NAMES, made):
        by_text = spark.sql(views.view_sql(kpi, named))
        assert rows(rounded(spark.table(view))) == rows(rounded(by_text))
        spark.sql(f"DROP VIEW {view}")
    # Repointing shows the new snapshot; dropping the table leaves its files.
    tables["dim_department"][0].limit(1).write.parquet(f"{base}/next")
    repoint_table(spark, "x_dim_department", f"{base}/next")
    assert spark.table("x_dim_department").count() == 1
    for name in tables:
        spark.sql(f"DROP TABLE x_{name}")
    assert spark.read.parquet(f"{base}/dim_department").count() == s.departments.count()


def test_external_table_over_a_partitioned_fact(spark, base):
    s = star(spark, SF)
    facts.write_fact_by_date(s.fact, base)
    table = create_external_table(spark, "x_fact", schemas.FACT, base, ("admission_date",))
    assert rows(table, *schemas.FACT.names) == rows(s.fact)
    spark.sql("DROP TABLE x_fact")


def test_table_counts(spark):
    got = {r.table_name: r.row_count for r in table_counts(star(spark, SF)).collect()}
    assert got["dim_patient"] == got["fact_patient_flow"] == 15


def test_broker_options():
    options = broker_options("h:9093", "encounters", "user", "secret", fail_on_data_loss=False)
    assert options["subscribe"] == "encounters" and options["startingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "false"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="user" password="secret"' in options["kafka.sasl.jaas.config"]
    plain = broker_options("h:9092", "encounters", max_offsets_per_trigger=10)
    assert plain["failOnDataLoss"] == "true" and "kafka.sasl.mechanism" not in plain
    assert plain["maxOffsetsPerTrigger"] == "10"


def test_broker_stream_asks_for_the_connector(spark):
    try:
        frame = broker_stream(spark, servers="h:9092", topic="encounters")
    except AnalysisException as e:
        assert "kafka" in str(e).lower()
    else:
        assert "value" in frame.columns
