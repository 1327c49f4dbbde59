"""The KPI views, as session views over a star and as catalogue views over named tables."""

from pyspark.sql import SparkSession

from wardstream.operators.kpis import KPIS, OVERSTAY_HOURS, Star

# View names.
VIEW_NAMES = {
    "bed_occupancy": "vw_bed_occupancy",
    "bed_turnover_rate": "vw_bed_turnover_rate",
    "patient_demographics": "vw_patient_demographics",
    "avg_treatment_duration": "vw_avg_treatment_duration",
    "patient_volume_trend": "vw_patient_volume_trend",
    "department_inflow": "vw_department_inflow",
    "overstay_patients": "vw_overstay_patients",
    "bed_occupancy_dept": "vw_bed_occupancy_dept",
}
# Views by gender slice, for those who read through SQL: name suffix and the gender kept.
SLICES = {"female": "Female", "male": "Male"}


def register_star(star: Star) -> None:
    """Name the three tables in the session."""
    star.fact.createOrReplaceTempView("fact_patient_flow")
    star.patients.createOrReplaceTempView("dim_patient")
    star.departments.createOrReplaceTempView("dim_department")


def register_views(star: Star, gender: str | None = None) -> None:
    """Session views named as in the catalogue, optionally sliced by gender."""
    for kpi, view in VIEW_NAMES.items():
        KPIS[kpi](star, gender).createOrReplaceTempView(view)


_PATIENTS = "JOIN {dim_patient} p ON p.surrogate_key = f.patient_sk"
_DEPARTMENTS = "JOIN {dim_department} d ON d.surrogate_key = f.department_sk"

# Key columns, measure, row filter.
_OCCUPANCY = (
    "100 * (CAST(count(f.bed_id) FILTER (WHERE f.is_currently_admitted) AS DOUBLE)"
    " / nullif(count(f.bed_id), 0)) AS bed_occupancy_percent"
)
_MEASURES = {
    "bed_occupancy_dept": ("d.department, p.gender", _OCCUPANCY, ""),
    "bed_occupancy": (
        "p.gender",
        _OCCUPANCY,
        "",
    ),
    "bed_turnover_rate": (
        "p.gender",
        "CAST(count(f.fact_id) AS DOUBLE) / nullif(count(DISTINCT f.bed_id), 0)"
        " AS bed_turnover_rate",
        "",
    ),
    "patient_demographics": (
        "p.gender",
        "count_if(f.is_currently_admitted) AS total_patients",
        "",
    ),
    "avg_treatment_duration": (
        "d.department, p.gender",
        "avg(f.length_of_stay_hours) AS avg_treatment_duration",
        "",
    ),
    "patient_volume_trend": (
        "f.admission_date, p.gender",
        "count(f.fact_id) AS patient_count",
        "",
    ),
    "department_inflow": (
        "d.department, p.gender",
        "count_if(f.is_currently_admitted) AS patient_count",
        "",
    ),
    "overstay_patients": (
        "d.department, p.gender",
        "count(f.fact_id) AS overstay_count",
        f"WHERE f.length_of_stay_hours > {OVERSTAY_HOURS}",
    ),
}


def view_sql(kpi: str, tables: dict[str, str], gender: str | None = None) -> str:
    """SELECT statement of a KPI over catalogue tables, given their names; ``gender`` slices it."""
    keys, measure, where = _MEASURES[kpi]
    if gender is not None:
        where = f"{where} {'AND' if where else 'WHERE'} p.gender = '{gender}'"
    joins = _PATIENTS + (f" {_DEPARTMENTS}" if "d." in keys else "")
    text = f"SELECT {keys}, {measure} FROM {{fact_patient_flow}} f {joins} {where} GROUP BY {keys}"
    return text.format(**tables)


def create_views(spark: SparkSession, tables: dict[str, str], prefix: str = "") -> list[str]:
    """Lasting views over catalogue tables; ``prefix`` may name a schema, as ``"kpi."``."""
    names = []
    for suffix, gender in {"": None, **{f"_{s}": g for s, g in SLICES.items()}}.items():
        for kpi, view in VIEW_NAMES.items():
            name = f"{prefix}{view}{suffix}"
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS {view_sql(kpi, tables, gender)}")
            names.append(name)
    return names
