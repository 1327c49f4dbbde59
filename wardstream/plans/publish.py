"""Name the stored gold tables and the KPI views in the catalogue."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardstream import schemas
from wardstream.operators.kpis import Star
from wardstream.plans.gold import Gold
from wardstream.plans.parted import FACT_KEPT, PART, PartedGold
from wardstream.plans.views import create_views
from wardstream.sources.snapshot import SnapshotTable
from wardstream.sources.tables import create_external_table, repoint_table


def _switch(spark: SparkSession, name: str, table: str, columns: list[str]) -> None:
    """Let the view ``name`` read ``table``, in one catalogue step, and drop the tables it read before."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(columns)} FROM {table}")
    _drop_others(spark, name, table)


def _drop_others(spark: SparkSession, name: str, table: str) -> None:
    database, prefix = name.rsplit(".", 1)
    for other in spark.catalog.listTables(database):
        mine = other.name.startswith(f"{prefix}_v") and not other.isTemporary
        if mine and other.tableType != "VIEW" and other.name != table.rsplit(".", 1)[1]:
            spark.sql(f"DROP TABLE {database}.{other.name}")


def _publish_version(table: SnapshotTable, name: str, column: str) -> None:
    """The live version of a table stored by ``column``: only its folders are in the catalogue."""
    spark, version = table.spark, table.version()
    target = f"{name}_v{version}"
    if not spark.catalog.tableExists(target):
        create_external_table(spark, target, table.schema, table.folder(version), (column,))
    _switch(spark, name, target, table.schema.names)


def _publish_folders(table: SnapshotTable, name: str, column: str) -> None:
    """The live folders of a table whose closed rows stay where they were written.

    There are at most ``FULL_EVERY`` of them and one, however many versions there were.
    """
    spark, version = table.spark, table.version()
    target = f"{name}_v{version}"
    if not spark.catalog.tableExists(target):
        columns = T.StructType([*table.schema, T.StructField("v", T.LongType())])
        spark.sql(
            f"CREATE TABLE {target} ({schemas.ddl(columns)}) USING parquet"
            f" PARTITIONED BY (v, {column}) LOCATION '{table.path}'"
        )
        for v, path in table.live_folders():
            value = path.rsplit("=", 1)[1]
            spark.sql(
                f"ALTER TABLE {target} ADD PARTITION (v = {v}, {column} = {value})"
                f" LOCATION '{path}'"
            )
    _switch(spark, name, target, table.schema.names)


def publish(gold: Gold, database: str) -> list[str]:
    """Point catalogue names at the last complete snapshots; run after each refresh.

    Every name changes in one catalogue step, so a reader sees a table's old snapshot or its new
    one. The catalogue holds the live versions only: its size follows the tables, not the number
    of refreshes. Departments come first and are never dropped, so every published fact finds its own.
    """
    spark = gold.spark
    departments = f"{database}.dim_department"
    folder = gold.departments.folder(gold.departments.version())
    if spark.catalog.tableExists(departments):
        repoint_table(spark, departments, folder)
    else:
        create_external_table(spark, departments, gold.departments.schema, folder)

    _publish_folders(gold.patients, f"{database}.dim_patient", "is_current")
    _publish_version(gold.fact, f"{database}.fact_patient_flow", "admission_date")

    names = ("dim_patient", "dim_department", "fact_patient_flow")
    return create_views(spark, {n: f"{database}.{n}" for n in names}, prefix=f"{database}.")


def publish_parts(gold: PartedGold, database: str) -> list[str]:
    """Point catalogue names at the parts of the last refresh, all of them of one manifest.

    The catalogue holds the live parts only. What moves with the clock is part of the fact's view, so a refresh that brings no rows
    changes one view. The names change one after another, the fact last but departments and versions are never taken away, so a
    reader in between finds the dimensions of each fact.
    """
    spark, state, version = gold.spark, gold.state(), gold.manifest.version()
    if not state.departments:
        raise FileNotFoundError(f"no complete refresh at {gold.path}")
    clock = f"TIMESTAMP_NTZ '{state.as_of}'"
    moving = {
        "is_currently_admitted": f"coalesce(discharge_time > {clock}, false) AS is_currently_admitted",
        "event_ingestion_time": f"{clock} AS event_ingestion_time",
    }
    departments = f"{database}.dim_department"
    create_external_table(
        spark, f"{departments}_v{version}", schemas.DIM_DEPARTMENT, gold.folder("dim_department", state.departments)
    )
    _switch(spark, departments, f"{departments}_v{version}", schemas.DIM_DEPARTMENT.names)
    for name, schema, columns in (
        ("dim_patient", schemas.DIM_PATIENT, schemas.DIM_PATIENT.names),
        ("fact_patient_flow", FACT_KEPT, [moving.get(c, c) for c in schemas.FACT.names]),
    ):
        target = f"{database}.{name}_v{version}"
        spark.sql(f"DROP TABLE IF EXISTS {target}")
        spark.sql(
            f"CREATE TABLE {target} ({schemas.ddl(schema)}, {PART} BIGINT) USING parquet"
            f" PARTITIONED BY ({PART}) LOCATION '{gold.path}/{name}'"
        )
        places = (
            f"PARTITION ({PART} = {part}) LOCATION '{gold.folder(name, refresh)}/{PART}={part}'" for part, refresh in gold.live(state)
        )
        spark.sql(f"ALTER TABLE {target} ADD {' '.join(places)}")
        _switch(spark, f"{database}.{name}", target, columns)
    names = ("dim_patient", "dim_department", "fact_patient_flow")
    return create_views(spark, {n: f"{database}.{n}" for n in names}, prefix=f"{database}.")


def publish_bucketed(star: Star, database: str, buckets: int, version: int = 1) -> list[str]:
    """The star as catalogue tables in ``buckets`` files by patient key, sorted by it, and the KPI views over them.

    The patient lookup of each report then needs no exchange of the fact, whatever the size of the dimension: files of one number meet. A
    bucket is read by one task, so take enough buckets for the fact; a patient with much of the fact is in one of them, and such a
    fact is better published as it is, for joins that split a hot key. Give each call another ``version``.
    """
    spark = star.fact.sparkSession
    for name, rows, key in (
        ("dim_department", star.departments, None),
        ("dim_patient", star.patients, "surrogate_key"),
        ("fact_patient_flow", star.fact, "patient_sk"),
    ):
        target = f"{database}.{name}_v{version}"
        writer = rows.write
        if key is not None:
            # One file a bucket: the rows are dealt as the buckets are.
            writer = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        writer.format("parquet").mode("overwrite").saveAsTable(target)
        _switch(spark, f"{database}.{name}", target, rows.columns)
    names = ("dim_patient", "dim_department", "fact_patient_flow")
    return create_views(spark, {n: f"{database}.{n}" for n in names}, prefix=f"{database}.")


def catalogue_star(spark: SparkSession, database: str, grain: str = "patient") -> Star:
    """The published tables, as the KPIs take them."""

    def table(name: str) -> DataFrame:
        return spark.table(f"{database}.{name}")

    return Star(table("fact_patient_flow"), table("dim_patient"), table("dim_department"), grain)
