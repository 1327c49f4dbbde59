"""Rule violations of a stream, kept for each of its batches."""

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

_LOG = "query string, batch bigint, at string, counts map<string, bigint>"
ROWS = "rows_checked"


class QualityLog(StreamingQueryListener):
    """Appends what streams observe under ``name`` to the table at ``path``, a row per batch.

    Use it as a context, or add and remove it by hand. Counts reach a listener after the batch is done, so a driver that dies in
    between leaves a batch without counts: :func:`missing_batches` names those. A batch that is run again is logged again, and
    readers take its last counts.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "dq"):
        self.spark, self.path, self.name = spark, path, name
        self.logged: dict[str, int] = {}

    def __enter__(self) -> "QualityLog":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.name)
        if seen is not None and progress.numInputRows:
            counts = {k: int(v or 0) for k, v in seen.asDict().items()}
            row = (str(progress.id), progress.batchId, progress.timestamp, counts)
            self.spark.createDataFrame([row], _LOG).coalesce(1).write.mode("append").parquet(self.path)
        self.logged[str(progress.id)] = progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the counts of the last batch that ``query`` reported are logged."""
        last = query.lastProgress
        end = time.monotonic() + seconds
        while last is not None and self.logged.get(str(query.id), -1) < last["batchId"]:
            if time.monotonic() > end:
                raise TimeoutError(f"no counts of batch {last['batchId']}")
            time.sleep(0.05)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """The counts of each batch: of one logged more than once, the last."""
    log = spark.read.schema(_LOG).parquet(path)
    last = F.row_number().over(Window.partitionBy("query", "batch").orderBy(F.col("at").desc()))
    return log.withColumn("k", last).filter("k = 1").drop("k")


def missing_batches(spark: SparkSession, path: str) -> DataFrame:
    """Numbers up to the last one logged that no counts are there for, per query: lost, or batches without rows."""
    held = batches(spark, path).groupBy("query").agg(F.collect_set("batch").alias("held"), F.max("batch").alias("last"))
    return held.select("query", F.explode(F.array_except(F.sequence(F.lit(0).cast("long"), "last"), "held")).alias("batch"))


def profile(spark: SparkSession, path: str) -> DataFrame:
    """Violations per rule over all batches, as :func:`wardstream.operators.clean.dq_profile` has them: ``(rule, violations,
    rows_checked)``."""
    each = batches(spark, path).select(F.col("counts")[ROWS].alias("n"), F.explode("counts").alias("rule", "violations"))
    total = each.groupBy("rule").agg(F.sum("violations").alias("violations"), F.sum("n").alias(ROWS))
    return total.filter(F.col("rule") != ROWS)
