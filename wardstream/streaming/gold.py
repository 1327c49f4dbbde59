"""Gold kept up to date from the silver stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardstream import schemas
from wardstream.functions.clock import read_clock
from wardstream.operators import clean
from wardstream.plans.gold import Gold
from wardstream.plans.parted import PartedGold


def latest_changes(silver: DataFrame) -> DataFrame:
    """The latest encounter so far of each patient with new rows, for a stream in update mode.

    The state holds one encounter per patient; what a batch emits is as large as the batch, however many patients there are.
    The order is that of :func:`wardstream.operators.latest.latest_encounter`. Events may come in any order, so the state of a patient
    is never dropped; keep it in RocksDB.
    """
    order = F.struct("admission_time", "arrived_at", "event_id")
    others = F.struct(*(c for c in schemas.SILVER.names if c != "patient_id"))
    newest = clean.accepted(silver).groupBy("patient_id").agg(F.max_by(others, order).alias("newest"))
    return newest.select("patient_id", "newest.*").select(*schemas.SILVER.names)


def start_gold(
    silver: DataFrame,
    gold: Gold | PartedGold,
    checkpoint: str,
    as_of=None,
    available_now: bool = False,
    trigger: str | None = None,
) -> StreamingQuery:
    """Refresh the gold tables with each micro-batch of silver; with a ``PartedGold``, only the parts that
    the batch touches. With one that keeps no latest encounters, the stream's state holds them, and each batch brings
    the changed patients alone.

    A batch replayed after a crash leads to the same tables, since a refresh can be repeated.
    Without ``as_of`` each batch takes the clock once and uses it for all tables.
    """

    def refresh(batch: DataFrame, _: int) -> None:
        gold.refresh(batch, read_clock(batch.sparkSession, as_of))

    writer = silver.writeStream
    if isinstance(gold, PartedGold) and not gold.keeps_latest:
        writer = latest_changes(silver).writeStream.outputMode("update")
    writer = writer.option("checkpointLocation", checkpoint).foreachBatch(refresh)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger is not None:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
