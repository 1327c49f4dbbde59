"""Gold build: latest state, both dimensions and the fact."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstream import schemas
from wardstream.functions.clock import read_clock
from wardstream.operators import clean, dims, fact, scd2
from wardstream.operators.keys import duplicate_keys
from wardstream.operators.kpis import Star
from wardstream.operators.latest import latest_encounter
from wardstream.session import materialise
from wardstream.sources.snapshot import SnapshotTable


def build_star(
    silver: DataFrame, as_of=None, grain: str = "patient", dense_keys: bool = False
) -> Star:
    """First-load star from silver rows.

    Patient keys are hashes, good for some 10**8 patients; ``dense_keys`` numbers them exactly, for
    any number, at the price of a sort of the patients.

    The latest encounters feed both dimensions and the fact, so they are stored: silver is
    scanned and shuffled once, not three times. The departments are stored because joins then go
    by their true size, which is what the planner's broadcast limit checks: as a rule the lookup
    is a broadcast and the fact does not shuffle for it. The patient dimension is a projection of
    the stored encounters and needs no copy.
    """
    as_of = read_clock(silver.sparkSession, as_of)
    usable = clean.accepted(silver)
    latest = materialise(latest_encounter(usable), "latest")
    # At visit grain every visit needs its department, not only the last one of each patient.
    rows = usable if grain == "visit" else latest
    departments = materialise(dims.dim_department(rows), "departments")
    patients = scd2.scd2_init(scd2.incoming_patients(latest), as_of, hashed=not dense_keys)
    if dense_keys:
        patients = materialise(scd2.with_dense_keys(patients, 0), "patients")
    return Star(
        fact.fact_patient_flow(rows, patients, departments, as_of), patients, departments, grain
    )


@dataclass
class Gold:
    """The stored gold tables under one folder.

    ``dense_keys`` numbers patient versions exactly and suits any size; without it the keys are
    60-bit hashes, which need no extra shuffle and suit up to some 10**8 versions.
    """

    spark: SparkSession
    path: str
    dense_keys: bool = True

    def __post_init__(self):
        self.latest = SnapshotTable(self.spark, f"{self.path}/latest", schemas.SILVER)
        self.patients = SnapshotTable(
            self.spark, f"{self.path}/dim_patient", schemas.DIM_PATIENT, open_column="is_current"
        )
        self.departments = SnapshotTable(
            self.spark, f"{self.path}/dim_department", schemas.DIM_DEPARTMENT
        )
        self.fact = SnapshotTable(
            self.spark,
            f"{self.path}/fact_patient_flow",
            schemas.FACT,
            partition_by="admission_date",
        )

    def refresh(self, silver: DataFrame, as_of=None) -> dict[str, int]:
        """Bring all tables up to date with ``silver``: the full table, or only its new rows.

        The stored latest encounters stand for everything seen before, so new rows are enough.
        Repeating a refresh, as after a crash half way, changes nothing that was already done:
        the same rows win again, unchanged patients keep their version, and the rest is rebuilt
        from these. Returns rows written per table.
        """
        as_of = read_clock(self.spark, as_of)
        written = {"latest": self.latest.replace(self._latest(silver))}
        latest = self.latest.read()
        written["dim_patient"] = self.patients.replace(self._patients(latest, as_of))
        written["dim_department"] = self.departments.replace(self._departments(latest))
        written["fact_patient_flow"] = self.fact.replace(
            fact.fact_patient_flow(latest, self.patients.read(), self.departments.read(), as_of)
        )
        return written

    def _latest(self, silver: DataFrame) -> DataFrame:
        rows = clean.accepted(silver).select(*schemas.SILVER.names)
        if self.latest.exists():
            rows = self.latest.read().unionByName(rows)
        return latest_encounter(rows)

    def _departments(self, latest: DataFrame) -> DataFrame:
        """Every department ever seen, so that facts published before keep theirs."""
        rows = dims.dim_department(latest)
        if self.departments.exists():
            rows = rows.unionByName(self.departments.read()).distinct()
        return rows

    def _patients(self, latest: DataFrame, as_of) -> DataFrame:
        """The current versions and the ones this run closes; older history is not touched."""
        incoming = scd2.incoming_patients(latest)
        if not self.patients.exists():
            versions, top = scd2.scd2_init(incoming, as_of, hashed=not self.dense_keys), 0
        else:
            held = self.patients.read()
            versions = scd2.merge_current(
                scd2.current_versions(held), incoming, as_of, hashed=not self.dense_keys
            )
            top = held.agg(F.max("surrogate_key")).first()[0] or 0
        return scd2.with_dense_keys(versions, top) if self.dense_keys else versions

    def star(self) -> Star:
        return Star(self.fact.read(), self.patients.read(), self.departments.read())

    def counts(self) -> DataFrame:
        return table_counts(self.star())

    def check_keys(self) -> None:
        """Raise if a key that must be unique is not."""
        star = self.star()
        for name, df, key in (
            ("dim_patient", star.patients, "surrogate_key"),
            ("dim_department", star.departments, "surrogate_key"),
            ("fact_patient_flow", star.fact, "fact_id"),
        ):
            if not duplicate_keys(df, key).isEmpty():
                raise ValueError(f"{name}.{key} is not unique")


def table_counts(star: Star) -> DataFrame:
    """Rows per gold table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in (
            ("dim_patient", star.patients),
            ("dim_department", star.departments),
            ("fact_patient_flow", star.fact),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
