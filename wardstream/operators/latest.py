"""Latest row per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """One row per key: the greatest by ``order``.

    The rank filter becomes a group limit on both sides of the shuffle, so a map task sends at
    most one row per key and a hot key costs no reducer more than one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    descending = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    ranked = df.withColumn(
        "row_num", F.row_number().over(Window.partitionBy(*keys).orderBy(*descending))
    )
    return ranked.filter("row_num = 1").drop("row_num")


def latest_encounter(encounters: DataFrame) -> DataFrame:
    """Each patient's latest admission; equal times are settled by the later arrival, then by the
    event's number (at one time of arrival, partitions have no order among them)."""
    order = ["admission_time", "arrived_at", "event_id"]
    return latest_by_key(
        encounters, "patient_id", [c for c in order if c in encounters.columns]
    )
