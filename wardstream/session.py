"""Session defaults and the shared scratch folder."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(
    app: str = "wardstream", cores: str | int = 8, memory: str = "8g"
) -> SparkSession:
    """A session for tests and the benchmark. On a cluster, pass the cluster's own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="wardstream-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path under the folder shared by all executors (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root()
    return f"{root.rstrip('/')}/wardstream/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, files: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds several consumers: the lineage ends at a table that survives the
    loss of executors, and the reader's real size lets the planner choose broadcasts safely.
    ``files``: how many files are enough (there may be fewer), for tables that have far more shuffle partitions than rows to fill them.
    """
    path = scratch_dir(df.sparkSession, label)
    (df.coalesce(files) if files else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
