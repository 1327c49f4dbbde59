"""A Parquet table replaced as a whole, readable while the next version is written.

Each version is its own folder, visible once Spark has put its ``_SUCCESS`` marker there. A run
that dies before that leaves the previous version in place, and its retry overwrites the
leftovers. One writer at a time is assumed. This is a naming convention over Spark's own reader
and writer, not a table format. Folders of earlier versions may be removed by a retention job, but
for those of a table with ``open_column`` since its last full version.
"""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstream.sources.tables import matching_paths


#: Each version whose number is a multiple of this holds every row, closed ones too.
FULL_EVERY = 32
#: Settings that a version depends on, whatever the session says: all of its folder is replaced, and the marker is written.
_COMPLETE = {
    "partitionOverwriteMode": "static",
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "true",
}


class SnapshotTable:
    """``open_column`` names a boolean column whose false rows never change once written.

    Such rows are written once and kept; only the true rows are rewritten by each version. Each
    ``FULL_EVERY``-th version is written in full, so a reader opens a bounded number of folders.
    ``partition_by`` names a column that readers filter on, each value in a folder of its own.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        open_column: str | None = None,
        partition_by: str | None = None,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.open_column, self.partition_by = open_column, partition_by

    def version(self) -> int:
        """The last complete version, 0 when there is none."""
        done = matching_paths(self.spark, f"{self.path}/v=*/_SUCCESS")
        return max((int(p.split("/")[-2].removeprefix("v=")) for p in done), default=0)

    def exists(self) -> bool:
        return self.version() > 0

    def folder(self, version: int) -> str:
        return f"{self.path}/v={version}"

    def live_folders(self) -> list[tuple[int, str]]:
        """Version and path of the folders that hold the rows of a table with ``open_column``."""
        version = self._present()
        full = version - version % FULL_EVERY
        wanted = [(version, f"v={version}/{self.open_column}=true")]
        wanted += [
            (v, f"v={v}/{self.open_column}=false") for v in range(max(full, 1), version + 1)
        ]
        found = {}
        for v, folder in wanted:
            if matching_paths(self.spark, f"{self.path}/{folder}"):
                found[f"{self.path}/{folder}"] = v
        return [(v, path) for path, v in found.items()]

    def _present(self) -> int:
        version = self.version()
        if version == 0:
            raise FileNotFoundError(f"no complete version of a table at {self.path}")
        return version

    def read(self) -> DataFrame:
        """Every row of the last complete version. Raises if there is none."""
        version = self._present()
        if self.open_column is None:
            rows = self.spark.read.schema(self.schema).parquet(self.folder(version))
            return rows.select(*self.schema.names)
        # Open rows of this version, closed rows of every version since the last full one.
        paths = [path for _, path in self.live_folders()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        schema = T.StructType([*self.schema, T.StructField("v", T.LongType())])
        rows = self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)
        return rows.select(*self.schema.names)

    def replace(self, df: DataFrame) -> int:
        """Write ``df`` as the next version; returns the number of rows written.

        ``df`` may read this table. With ``open_column``, pass the open rows and the newly closed
        ones; rows closed earlier are kept without being rewritten, but for full versions. Raises if
        the new version cannot be seen afterwards.
        """
        seen = Observation()
        rows = df.select(*self.schema.names)
        version = self.version() + 1
        if self.open_column is not None and version > 1 and version % FULL_EVERY == 0:
            rows = rows.unionByName(self.read().filter(~F.col(self.open_column)))
        if self.partition_by is not None:
            # Few files per value, and a value with much of the data spread over many tasks.
            rows = rows.hint("rebalance", self.partition_by)
        writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        writer = writer.options(**_COMPLETE)
        folders = [c for c in (self.open_column, self.partition_by) if c is not None]
        if folders:
            writer = writer.partitionBy(*folders)
        writer.parquet(self.folder(version))
        if self.version() != version:
            raise RuntimeError(f"{self.folder(version)} was written but has no marker")
        return seen.get.get("rows", 0)

    def append(self, df: DataFrame) -> int:
        """Add rows, matched by name: the next version is the present one and ``df``.

        With ``open_column``, rows closed earlier stay where they are.
        """
        if not self.exists():
            return self.replace(df)
        held = self.read()
        if self.open_column is not None:
            held = held.filter(F.col(self.open_column))
        return self.replace(held.unionByName(df))
