"""Table sources: streams over a growing table, and external tables over gold folders."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardstream import schemas

EXTERNAL = {
    "dim_patient": schemas.DIM_PATIENT,
    "dim_department": schemas.DIM_DEPARTMENT,
    "fact_patient_flow": schemas.FACT,
}


def table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A table or folder as an unbounded frame: files present now, then each file added."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, on any file system Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; nothing if it is absent."""
    files, path = _file_system(spark, path)
    files.delete(path, True)


def touch_path(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``; nothing if it is there."""
    files, path = _file_system(spark, path)
    files.createNewFile(path)


def create_external_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str,
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """(Re)declare ``name`` over the Parquet files at ``path``; dropping it keeps the files."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE {name} ({schemas.ddl(schema)}) USING parquet {parts} LOCATION '{path}'"
    )
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def repoint_table(spark: SparkSession, name: str, path: str) -> None:
    """Move an external table to a newer snapshot folder in one catalogue step."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
