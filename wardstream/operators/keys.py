"""Exact surrogate keys for any number of rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstream.session import materialise

# monotonically_increasing_id() keeps the partition above, and the row's place below, this bit.
_ROW_BITS = 33


def dense_keys(
    df: DataFrame, order_by: Sequence[str], start: int = 0, name: str = "surrogate_key"
) -> DataFrame:
    """Number the rows ``start + 1 ...`` in the global order of ``order_by`` (unique per row).

    The rows are range-partitioned and sorted, stored once, and numbered as (rows in earlier
    partitions) + (place in own partition). No task sees more than its own range, and the
    numbers depend only on the data, not on the number of partitions.
    """
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    # Stored because range bounds come from a sample: counts and numbers must see the same split.
    stored = materialise(placed, "dense-keys").withColumn(
        "_part", F.shiftright("_place", _ROW_BITS)
    )
    # One row per partition, so neither this window nor the broadcast grows with the data.
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    place = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.lit(start) + F.col("_before") + place + 1)
        .drop("_part", "_place", "_before")
    )


def duplicate_keys(df: DataFrame, key: str = "surrogate_key") -> DataFrame:
    """Keys held by more than one row; empty for a valid dimension or fact."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
