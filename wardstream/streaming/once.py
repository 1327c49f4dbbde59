"""Each event once, however late it is delivered again."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardstream.operators.latest import latest_by_key
from wardstream.session import materialise
from wardstream.sources.tables import matching_paths
from wardstream.streaming.owner import claim, mark

DAY, BATCH = "event_day", "batch"
#: The folder of rows without a day, a fixed value of the file layout.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def stored_keys(spark: SparkSession, path: str, key: T.StructField, days: Sequence, before: int) -> DataFrame:
    """The keys stored under ``days`` by batches before ``before``. No other day's folder is opened or listed."""
    folders = [f"{path}/{DAY}={NO_DAY if d is None else d}" for d in days]
    held = [f for f in folders if matching_paths(spark, f)]
    if not held:
        return spark.createDataFrame([], T.StructType([key]))
    schema = T.StructType([key, T.StructField(DAY, T.DateType()), T.StructField(BATCH, T.LongType())])
    rows = spark.read.schema(schema).option("basePath", path).parquet(*held)
    return rows.filter(F.col(BATCH) < before).select(key.name)


def not_stored(batch: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key is not among ``keys``.

    The stored keys are first cut to those of the batch. That join has the batch as its small side: it is broadcast
    below the planner's limit, and beyond that a Bloom filter of the batch's keys meets the stored ones where they are read
    (``spark.sql.optimizer.runtime.bloomFilter.enabled``).
    """
    again = keys.join(batch.select(key), key, "left_semi").distinct()
    return batch.join(again, key, "left_anti")


def start_once(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "event_id",
    time: str = "admission_time",
    order: Sequence[str] = ("arrived_at",),
    available_now: bool = False,
    trigger: str | None = None,
) -> StreamingQuery:
    """Append each event of ``rows`` to the table at ``path``, unless its key is stored already.

    There is no watermark and no state: a batch is compared with what the table holds, and only under the days of ``time`` that the
    batch has. So ``time`` must be what the event itself says, the same in every delivery: an admission that was set to the clock because
    it was missing may pass again under another day. Of an event that comes twice in a batch, the first by ``order`` is kept.

    A batch lies in folders of its own, and one replayed after a crash replaces them and is not compared with itself. A row
    without a key is never taken for another.
    """
    spark = rows.sparkSession
    claim(spark, path, checkpoint, f"{DAY}=*")
    field = rows.schema[key]

    def keep(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # In one order on each replay, so the same row is kept.
        rest = [F.xxhash64(*(c for c in batch.columns))]
        earliest = latest_by_key(
            batch.filter(F.col(key).isNotNull()).withColumns({f"_{i}": -F.unix_micros(F.col(c).cast("timestamp")) for i, c in enumerate(order)}),
            key, [*(f"_{i}" for i in range(len(order))), *rest],
        ).select(*batch.columns)
        keyless = batch.filter(F.col(key).isNull())
        single = earliest.unionByName(keyless).withColumn(DAY, F.to_date(time))
        single = materialise(single, "once")
        days = [r[DAY] for r in single.select(DAY).distinct().collect()]  # the days of one batch
        fresh = not_stored(single, stored_keys(session, path, field, days, number), key)
        (
            fresh.withColumn(BATCH, F.lit(number).cast("long"))
            .hint("rebalance", DAY)
            .write.partitionBy(DAY, BATCH)
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(path)
        )

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger is not None:
        writer = writer.trigger(processingTime=trigger)
    query = writer.start()
    mark(spark, path, query.id)
    return query


def read_once(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The events kept so far; :data:`DAY` can be filtered on before the columns are taken."""
    days = T.StructType([*schema, T.StructField(DAY, T.DateType())])
    return spark.read.schema(days).parquet(path).select(*schema.names)
