"""Each registered query as standalone SQL for an independent engine (DuckDB dialect)."""

from wardstream.sources.encounters import AS_OF, FAULTS, FAULTY, FIRST_LOAD, MALFORMED

_NOW = f"TIMESTAMP '{AS_OF}'"
_FIRST = f"TIMESTAMP '{FIRST_LOAD}'"


def _part(x: str) -> str:
    """One length-prefixed part of a natural key."""
    return f"coalesce(length(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"


def _key(*parts: str) -> str:
    text = " || ".join(_part(p) for p in parts)
    return f"CAST('0x' || substr(sha256({text}), 1, 15) AS BIGINT)"


def _print(row: str = "") -> str:
    p = f"{row}." if row else ""
    return f"sha256(coalesce({p}gender, 'NA') || '||' || coalesce(CAST({p}age AS VARCHAR), 'NA'))"


def _repaired(rows: str) -> str:
    return f"""
      SELECT event_id, patient_id, gender,
             CASE WHEN age > 100 THEN CAST((event_id % 90 + 90) % 90 + 1 AS INTEGER)
                  ELSE age END AS age,
             department,
             CASE WHEN admission_time IS NULL OR admission_time > {_NOW} THEN {_NOW}
                  ELSE admission_time END AS admission_time,
             discharge_time, bed_id, hospital_id, CAST(NULL AS TIMESTAMP) AS arrived_at
      FROM {rows}"""


def _unless(column: str, *faults: str) -> str:
    gone = ", ".join(str(FAULTS.index(f)) for f in ("unreadable", *faults))
    return f"CASE WHEN f NOT IN ({gone}) THEN {column} END AS {column}"


_CTES = {
    "typed": """
      SELECT event_id,
             CAST(user_id AS VARCHAR) AS patient_id,
             CASE WHEN user_id % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
             CAST(floor(value) AS INTEGER) AS age,
             event_type AS department,
             ts AS admission_time,
             ts + (event_id % 72 + 1) * INTERVAL 1 HOUR AS discharge_time,
             CAST(event_id % 500 + 1 AS INTEGER) AS bed_id,
             CAST(event_id % 7 + 1 AS INTEGER) AS hospital_id
      FROM events""",
    # Faulty events beside the real ones; f is the fault's number.
    "faulty": f"""
      SELECT *, -1 AS f FROM typed UNION ALL
      SELECT -1 - event_id, {_unless('patient_id', 'no patient')}, {_unless('gender')},
             {_unless('age', 'wrong type of age')}, {_unless('department', 'no department')},
             {_unless('admission_time', 'no admission')},
             CASE WHEN f = {FAULTS.index('discharge before admission')}
                  THEN admission_time - INTERVAL 5 HOUR
                  WHEN f NOT IN ({FAULTS.index('unreadable')}, {FAULTS.index('no discharge')})
                  THEN discharge_time END AS discharge_time,
             {_unless('bed_id', 'no bed')}, {_unless('hospital_id')}, f
      FROM (SELECT *, (event_id // {FAULTY}) % {len(FAULTS)} AS f FROM typed
            WHERE event_id % {FAULTY} = 0)""",
    "silver": _repaired("typed"),
    "silver_faulty": _repaired("faulty"),
    "usable": "SELECT * FROM silver WHERE patient_id IS NOT NULL",
    "latest": """
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
          PARTITION BY patient_id ORDER BY admission_time DESC, event_id DESC) AS rn
        FROM usable) WHERE rn = 1""",
    "latest1": f"""
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
          PARTITION BY patient_id ORDER BY admission_time DESC, event_id DESC) AS rn
        FROM usable WHERE admission_time < {_FIRST}) WHERE rn = 1""",
    "dim1": f"""
      SELECT patient_id, gender, age, {_FIRST} AS effective_from,
             {_key('patient_id', _FIRST)} AS surrogate_key,
             CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current
      FROM latest1""",
    "changed": f"""
      SELECT d.* FROM dim1 d JOIN latest l USING (patient_id)
      WHERE {_print('d')} <> {_print('l')}""",
    "opened": f"""
      SELECT l.patient_id, l.gender, l.age, {_NOW} AS effective_from,
             {_key('l.patient_id', _NOW)} AS surrogate_key,
             CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current
      FROM latest l LEFT JOIN dim1 d USING (patient_id)
      WHERE d.patient_id IS NULL OR {_print('d')} <> {_print('l')}""",
    "closed": f"""
      SELECT patient_id, gender, age, effective_from, surrogate_key,
             {_NOW} AS effective_to, false AS is_current FROM changed""",
    "dim2": """
      SELECT * FROM dim1 WHERE patient_id NOT IN (SELECT patient_id FROM changed)
      UNION ALL SELECT * FROM closed UNION ALL SELECT * FROM opened""",
    "dim_patient": f"""
      SELECT patient_id, gender, age, {_NOW} AS effective_from,
             {_key('patient_id', _NOW)} AS surrogate_key,
             CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current
      FROM latest""",
}


def _department(rows: str) -> str:
    return f"""
      SELECT {_key('department', 'hospital_id')} AS surrogate_key, department, hospital_id
      FROM (SELECT DISTINCT department, hospital_id FROM {rows})"""


def _fact(rows: str, departments: str) -> str:
    return f"""
      SELECT r.event_id AS fact_id, p.surrogate_key AS patient_sk,
             d.surrogate_key AS department_sk, r.admission_time, r.discharge_time,
             CAST(r.admission_time AS DATE) AS admission_date,
             (floor(epoch(r.discharge_time)) - floor(epoch(r.admission_time))) / 3600e0
               AS length_of_stay_hours,
             coalesce(r.discharge_time > {_NOW}, false) AS is_currently_admitted,
             r.bed_id, {_NOW} AS event_ingestion_time
      FROM {rows} r
      LEFT JOIN dim_patient p ON p.patient_id = r.patient_id AND p.is_current
      LEFT JOIN {departments} d
        ON d.department = r.department AND d.hospital_id = r.hospital_id"""


_CTES["dim_department"] = _department("latest")
_CTES["dim_department_visits"] = _department("usable")
_CTES["fact"] = _fact("latest", "dim_department")
_CTES["fact_visits"] = _fact("usable", "dim_department_visits")


def _with(select: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in _CTES.items()) + f" {select}"


def _kpi(select: str, where: str = "", group: str = "p.gender", suffix: str = "") -> str:
    departments = (
        f"JOIN dim_department{suffix} d ON f.department_sk = d.surrogate_key"
        if "d." in group
        else ""
    )
    return f"""SELECT {group}, {select} FROM fact{suffix} f
      JOIN dim_patient p ON f.patient_sk = p.surrogate_key {departments} {where}
      GROUP BY {group}"""


_OCCUPANCY = """count(CASE WHEN f.is_currently_admitted THEN f.bed_id END) * 1e0
  / nullif(count(f.bed_id), 0) * 100 AS bed_occupancy_percent"""
_KPIS = {
    "bed_occupancy": (_OCCUPANCY,),
    "bed_occupancy_dept": (_OCCUPANCY, "", "d.department, p.gender"),
    "bed_turnover_rate": (
        "count(DISTINCT f.fact_id) * 1e0 / nullif(count(DISTINCT f.bed_id), 0)"
        " AS bed_turnover_rate",
    ),
    "patient_demographics": (
        "count(CASE WHEN f.is_currently_admitted THEN f.fact_id END) AS total_patients",
    ),
    "avg_treatment_duration": (
        "round(avg(f.length_of_stay_hours), 6) AS avg_treatment_duration",
        "",
        "d.department, p.gender",
    ),
    "patient_volume_trend": (
        "count(DISTINCT f.fact_id) AS patient_count",
        "",
        "f.admission_date, p.gender",
    ),
    "department_inflow": (
        "count(CASE WHEN f.is_currently_admitted THEN f.fact_id END) AS patient_count",
        "",
        "d.department, p.gender",
    ),
    "overstay_patients": (
        "count(f.fact_id) AS overstay_count",
        "WHERE f.length_of_stay_hours > 50",
        "d.department, p.gender",
    ),
}

_ISO = "'%Y-%m-%dT%H:%M:%S.%f'"
_FIELDS = ", ".join(
    f"""'"{name}":' || {text}"""
    for name, text in {
        "patient_id": "'\"' || patient_id || '\"'",
        "gender": "'\"' || gender || '\"'",
        "age": "age",
        "department": "'\"' || department || '\"'",
        "admission_time": f"'\"' || strftime(admission_time, {_ISO}) || '\"'",
        "discharge_time": f"'\"' || strftime(discharge_time, {_ISO}) || '\"'",
        "bed_id": "bed_id",
        "hospital_id": "hospital_id",
    }.items()
)
_JSON = f"""CASE WHEN f = {FAULTS.index('unreadable')} THEN '{MALFORMED}' ELSE
  '{{' || CASE WHEN f = {FAULTS.index('wrong type of age')} THEN '"age":"old",' ELSE '' END
  || array_to_string(list_filter([{_FIELDS}], lambda x: x IS NOT NULL), ',') || '}}' END"""
_BRONZE = f"SELECT event_id, {_JSON} AS raw_json, {_NOW} AS ingested_at FROM faulty"
_PLAIN = "event_id, patient_id, gender, age, department, bed_id, hospital_id"
_PARSED_TEXT = f"""SELECT {_PLAIN}, strftime(admission_time, {_ISO}) AS admission_time,
  strftime(discharge_time, {_ISO}) AS discharge_time FROM faulty"""
_PARSED_SILVER = f"SELECT * REPLACE ({_NOW} AS arrived_at) FROM silver_faulty"

_RULES = {
    "missing_patient": "patient_id IS NULL",
    "missing_admission": "admission_time IS NULL",
    "future_admission": f"admission_time > {_NOW}",
    "missing_discharge": "discharge_time IS NULL",
    "negative_stay": f"discharge_time < least(coalesce(admission_time, {_NOW}), {_NOW})",
    "dirty_age": "age > 100",
    "missing_age": "age IS NULL",
    "missing_department": "department IS NULL",
    "missing_bed": "bed_id IS NULL",
}

_TREND = """
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, gender,
         count(*) AS admissions
  FROM (SELECT date_trunc('hour', admission_time) AS window_start, gender FROM usable)
  WHERE window_start + INTERVAL 1 HOUR
        <= (SELECT max(date_trunc('millisecond', admission_time)) FROM usable) - INTERVAL 1 HOUR
  GROUP BY window_start, gender"""


# Daily loads: the last row of each patient and day, then runs of equal attributes.
_HISTORY = f"""
  SELECT patient_id, gender, age, batch_time AS effective_from,
         {_key('patient_id', 'batch_time')} AS surrogate_key,
         lead(batch_time) OVER w AS effective_to, lead(batch_time) OVER w IS NULL AS is_current
  FROM (
    SELECT *, lag({_print()}) OVER (PARTITION BY patient_id ORDER BY batch_time) AS before
    FROM (
      SELECT patient_id, gender, batch_time,
             CASE WHEN age > 100 THEN CAST(event_id % 90 + 1 AS INTEGER) ELSE age END AS age
      FROM (SELECT *, date_trunc('day', admission_time) + INTERVAL 1 DAY AS batch_time FROM typed)
      WHERE patient_id IS NOT NULL
      QUALIFY row_number() OVER (
        PARTITION BY patient_id, batch_time ORDER BY admission_time DESC, event_id DESC) = 1))
  WHERE before IS NULL OR before <> {_print()}
  WINDOW w AS (PARTITION BY patient_id ORDER BY batch_time)"""

# Exact keys: the first load numbers patients from 1, the second goes on after the greatest.
_GOLD = """
  SELECT c.* REPLACE (k.dense AS surrogate_key) FROM (
    SELECT * FROM dim1 WHERE patient_id NOT IN (SELECT patient_id FROM changed)
    UNION ALL SELECT * FROM closed) c
  JOIN (SELECT patient_id, row_number() OVER (ORDER BY patient_id) AS dense FROM dim1) k
    USING (patient_id)
  UNION ALL
  SELECT * REPLACE ((SELECT count(*) FROM dim1) + row_number() OVER (ORDER BY patient_id)
                    AS surrogate_key) FROM opened"""

_TIME = """
  SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date,
         CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
         CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
         CAST(weekofyear(date) AS INTEGER) AS iso_week,
         CAST(isodow(date) AS INTEGER) AS iso_weekday, isodow(date) >= 6 AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT min(admission_date) AS first, max(admission_date) AS last FROM fact))"""

# A time as Spark casts it to text: without trailing zeros in the fraction.
_SPARK_TEXT = "rtrim(rtrim(strftime(admission_time, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')"

_BODIES = {
    "bronze_decode": _BRONZE,
    "parse_events": _PARSED_TEXT,
    "type_times": "SELECT * EXCLUDE (f) FROM faulty",
    "clamp_admission": f"""SELECT * EXCLUDE (f) REPLACE (CASE WHEN admission_time IS NULL
        OR admission_time > {_NOW} THEN {_NOW} ELSE admission_time END AS admission_time)
        FROM faulty""",
    "impute_age": """SELECT * EXCLUDE (f) REPLACE (CASE WHEN age > 100
        THEN CAST((event_id % 90 + 90) % 90 + 1 AS INTEGER) ELSE age END AS age) FROM faulty""",
    "conform_schema": """SELECT * EXCLUDE (f) REPLACE (CAST(NULL AS INTEGER) AS bed_id,
        CAST(NULL AS TIMESTAMP) AS discharge_time), CAST(NULL AS TIMESTAMP) AS arrived_at
        FROM faulty""",
    "silver": _PARSED_SILVER,
    "quarantine": """SELECT event_id, department, admission_time,
        'missing patient_id' AS reason FROM silver_faulty WHERE patient_id IS NULL""",
    "rejected_input": f"""SELECT event_id, {_JSON} AS raw_json, {_NOW} AS ingested_at,
        CASE WHEN f = {FAULTS.index('unreadable')} THEN 'unreadable'
        ELSE 'missing patient_id' END AS reason FROM faulty WHERE patient_id IS NULL""",
    "dq_profile": " UNION ALL ".join(
        f"""SELECT count(*) AS rows_checked, '{rule}' AS rule,
        count(*) FILTER (WHERE {test}) AS violations FROM faulty"""
        for rule, test in _RULES.items()
    ),
    "surrogate_key": f"""SELECT event_id, {_key('patient_id', _SPARK_TEXT)} AS surrogate_key
        FROM faulty""",
    "dense_surrogate_key": """SELECT patient_id, event_id,
        row_number() OVER (ORDER BY patient_id, event_id) AS surrogate_key FROM usable""",
    "attr_fingerprint": f"SELECT event_id, gender, age, {_print()} AS attr_hash FROM silver_faulty",
    "latest_encounter": "SELECT * FROM latest",
    "dim_department": "SELECT * FROM dim_department",
    "scd2_init": "SELECT * FROM dim_patient",
    "scd2_new_keys": """SELECT patient_id, gender, age FROM latest
        WHERE patient_id NOT IN (SELECT patient_id FROM dim1)""",
    "scd2_changes": "SELECT surrogate_key, patient_id FROM changed",
    "scd2_close": "SELECT * FROM closed",
    "scd2_inserts": "SELECT * FROM opened",
    "scd2_apply": "SELECT * FROM dim2",
    "dim_patient_current": "SELECT * FROM dim2 WHERE is_current",
    "scd2_history": _HISTORY,
    "fact_patient_flow": "SELECT * FROM fact",
    "fact_by_visit": "SELECT * FROM fact_visits",
    "fact_by_date": "SELECT * FROM fact",
    "ext_table_scan": "SELECT * FROM fact",
    "dq_table_counts": """SELECT 'dim_patient' AS table_name, count(*) AS row_count
        FROM dim_patient
        UNION ALL SELECT 'dim_department', count(*) FROM dim_department
        UNION ALL SELECT 'fact_patient_flow', count(*) FROM fact""",
    "gold_refresh": _GOLD,
    "dim_time": _TIME,
    "bed_occupancy_dept_female": _kpi(
        _OCCUPANCY, "WHERE p.gender = 'Female'", "d.department, p.gender"
    ),
    "view_department_inflow": _kpi(*_KPIS["department_inflow"]),
    "stream_bronze": _BRONZE,
    "stream_silver": _PARSED_SILVER,
    "stream_gold": "SELECT * FROM fact",
    # Without the patient key, which tells in which batch a patient came first: all batches share a clock.
    "stream_gold_parts": "SELECT * FROM fact",
    "gold_refresh_parts": "SELECT * FROM dim2",
    "gold_refresh_split": "SELECT * EXCLUDE (surrogate_key), true AS exact_key FROM dim2",
    "stream_gold_state": "SELECT * FROM fact",
    "stream_trend": _TREND,
    "stream_trend_patients": _TREND.replace(
        "count(*) AS admissions", "count(*) AS admissions, count(DISTINCT patient_id) AS patients"
    ).replace("AS window_start, gender FROM", "AS window_start, gender, patient_id FROM"),
    "stream_dedup": "SELECT * EXCLUDE (arrived_at) FROM usable",
    "stream_once": "SELECT * EXCLUDE (arrived_at) FROM usable",
}
_BODIES["stream_quality"] = _BODIES["dq_profile"]
for _name, _spec in _KPIS.items():
    _select, _where, _group = (*_spec, "", "p.gender")[:3] if len(_spec) == 1 else _spec
    _BODIES[_name] = _kpi(_select, _where, _group)
    _BODIES[f"{_name}_visits"] = _kpi(_select, _where, _group, "_visits")
for _name in ("patient_demographics", "department_inflow"):
    _BODIES[f"{_name}_bucketed"] = _BODIES[f"{_name}_visits"]

ORACLE = {name: _with(body) for name, body in _BODIES.items()}
