import pytest
from conftest import CLOCK, SF, rounded, rows, silver
from pyspark.sql import functions as F

from wardstream.operators import dims, kpis
from wardstream.operators.kpis import KPIS
from wardstream.plans import views
from wardstream.plans.gold import build_star
from wardstream.plans.registry import silver_rows, star

def small(spark, *records, grain="patient"):
    return build_star(silver(spark, *records), CLOCK, grain)


def test_missing_department_counts_by_gender_only(spark):
    s = small(spark, {"patient_id": "a", "department": None}, {"patient_id": "b"})
    assert rows(s.fact.filter("department_sk IS NULL"), "fact_id") == [(1,)]
    assert rows(kpis.patient_volume_trend(s), "patient_count") == [(2,)]
    assert rows(kpis.bed_turnover_rate(s)) == [("Male", 2.0)]
    for kpi in (kpis.department_inflow, kpis.avg_treatment_duration):
        assert rows(kpi(s), "department") == [("ICU",)]
    assert rows(kpis.department_inflow(s), "patient_count") == [(0,)]


def test_no_beds_is_null_not_an_error(spark):
    s = small(spark, {"bed_id": None})
    assert rows(kpis.bed_occupancy(s)) == [("Male", None)]
    assert rows(kpis.bed_turnover_rate(s)) == [("Male", None)]
    assert rows(kpis.bed_occupancy_dept(s)) == [("ICU", "Male", None)]


def test_overstay_is_strictly_above_the_limit(spark):
    s = small(
        spark,
        {"patient_id": "a", "discharge_time": "2024-01-10 02:00:00"},
        {"patient_id": "b", "discharge_time": "2024-01-10 02:00:01"},
        {"patient_id": "c", "discharge_time": None},
    )
    assert rows(kpis.overstay_patients(s)) == [("ICU", "Male", 1)]


def test_mean_leaves_open_stays_out(spark):
    s = small(spark, {"patient_id": "a"}, {"patient_id": "b", "discharge_time": None})
    assert rows(kpis.avg_treatment_duration(s)) == [("ICU", "Male", 36.0)]
    none = small(spark, {"discharge_time": None})
    assert rows(kpis.avg_treatment_duration(none)) == [("ICU", "Male", None)]


def test_grains(spark):
    visits = [{"admission_time": "2024-01-07 00:00:00"}, {}]
    assert rows(small(spark, *visits).fact, "fact_id") == [(2,)]
    assert rows(small(spark, *visits, grain="visit").fact, "fact_id") == [(1,), (2,)]


@pytest.mark.parametrize("name", sorted(KPIS))
def test_slice_is_the_rows_of_that_gender(spark, name):
    s = star(spark, SF)
    whole = KPIS[name](s)
    ours = rounded(KPIS[name](s, "Female"))
    assert rows(ours) == rows(rounded(whole).filter(F.col("gender") == "Female"))


@pytest.mark.parametrize("name", sorted(views.VIEW_NAMES))
def test_sql_view_agrees(spark, name):
    s = star(spark, SF)
    views.register_star(s)
    tables = {n: n for n in ("fact_patient_flow", "dim_patient", "dim_department")}
    by_sql = spark.sql(views.view_sql(name, tables))
    ours = KPIS[name](s)
    assert by_sql.columns == ours.columns
    assert rows(rounded(by_sql)) == rows(rounded(ours))


def test_session_views(spark):
    views.register_views(star(spark, SF), gender="Male")
    for view in views.VIEW_NAMES.values():
        assert {r.gender for r in spark.table(view).collect()} == {"Male"}


@pytest.mark.parametrize("name", sorted(KPIS))
def test_visit_grain_does_not_depend_on_preaggregation(spark, name):
    """The early sum per patient must not change a result, also when one patient dominates."""
    base = silver_rows(spark, SF)
    hot = base.withColumn(
        "patient_id", F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("patient_id"))
    )
    s = build_star(hot, "2024-01-30 20:00:00", "visit")
    plain = kpis.Star(s.fact, s.patients, s.departments, "patient")
    assert rows(rounded(KPIS[name](s))) == rows(rounded(KPIS[name](plain)))


def test_dim_time_covers_every_day_once(spark):
    s = small(
        spark,
        {"patient_id": "a", "admission_time": "2023-12-30 10:00:00"},
        {"patient_id": "b", "admission_time": "2024-01-02 10:00:00"},
    )
    shown = ["date_key", "year", "quarter", "iso_week", "iso_weekday", "is_weekend"]
    got = rows(dims.dim_time(s.fact), *shown)
    assert got == [
        (20231230, 2023, 4, 52, 6, True),
        (20231231, 2023, 4, 52, 7, True),
        (20240101, 2024, 1, 1, 1, False),
        (20240102, 2024, 1, 1, 2, False),
    ]
    assert dims.dim_time(s.fact.filter("false")).isEmpty()


def test_department_pairs_with_null_have_their_own_row(spark):
    df = silver(spark, {"department": None}, {"department": ""}, {"department": "-"}, {})
    pairs = dims.dim_department(df)
    assert pairs.count() == 4
    assert pairs.select("surrogate_key").distinct().count() == 4
