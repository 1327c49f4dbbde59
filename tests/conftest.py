import json
import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wardstream import schemas  # noqa: E402
from wardstream.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"
CLOCK = "2024-01-10 00:00:00"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, "4g")
    yield session
    session.stop()


def t(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *order):
    """Rows as tuples, in a stable order."""
    cols = list(order) or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def rounded(kpi):
    """A KPI with its measure rounded: sums of doubles depend on the order of their terms."""
    from pyspark.sql import functions as F

    measure = kpi.columns[-1]
    return kpi.withColumn(measure, F.round(measure, 6))


def event(**changes) -> str:
    base = {
        "patient_id": "p",
        "gender": "Male",
        "age": 30,
        "department": "ICU",
        "admission_time": "2024-01-08T00:00:00",
        "discharge_time": "2024-01-09T12:00:00",
        "bed_id": 5,
        "hospital_id": 1,
    }
    return json.dumps({k: v for k, v in (base | changes).items() if v is not ...})


def bronze(spark, *texts):
    """Bronze rows with event ids 1, 2, ..."""
    data = [(i, text, t(CLOCK)) for i, text in enumerate(texts, 1)]
    return spark.createDataFrame(data, schemas.BRONZE)


def silver(spark, *records):
    """Silver rows from dicts; missing fields take the base event's values."""
    base = {
        "patient_id": "p",
        "gender": "Male",
        "age": 30,
        "department": "ICU",
        "admission_time": t("2024-01-08 00:00:00"),
        "discharge_time": t("2024-01-09 12:00:00"),
        "bed_id": 5,
        "hospital_id": 1,
        "arrived_at": t("2024-01-08 00:00:00"),
    }
    data = []
    for i, r in enumerate(records, 1):
        full = {"event_id": i} | base | r
        for c in ("admission_time", "discharge_time"):
            if isinstance(full[c], str):
                full[c] = t(full[c])
        data.append(tuple(full[c] for c in schemas.SILVER.names))
    return spark.createDataFrame(data, schemas.SILVER)
