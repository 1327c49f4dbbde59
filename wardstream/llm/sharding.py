"""Proportional stratified interleaving: every shard holds the corpus mixture.

Rows are put in a seeded random order within their source and get a fractional rank there,
``(rank - 1/2) / rows of the source``. Sorting by that fraction interleaves the sources in
proportion, and cutting the sequence into equal lengths gives shards whose counts differ by one
row at most and whose mixture is that of the corpus.

Neither ranking puts a source, a key or a fraction that many sources share into one task: rows are numbered by range
partitions, rows in earlier partitions and then the place in the own one.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstream.llm.common import hashable
from wardstream.operators.keys import dense_keys
from wardstream.session import materialise


def seeded(key: Column, seed: int) -> Column:
    """The seeded random order: hex text of a hash of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))


def interleave(
    df: DataFrame, key: str, source: str, n_shards: int = 8, seed: int = 1
) -> DataFrame:
    """``df`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in each shard).

    A null source is a source of its own, and a null key orders as the text ``null``. Rows of one
    key are ordered by a hash of their columns; only rows equal in all of them are interchangeable. Columns
    of the names ``shard`` and ``slot`` are replaced. An empty table stays empty.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be 1 or more")
    df = df.drop("shard", "slot")
    # Columns of the table are kept together, so that their names don't matter. Rows equal in all columns are interchangeable, and the salt
    # deals them out.
    rows = df.select(
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("stratum"),
        seeded(F.col(key), seed).alias("order"),
        F.xxhash64(*hashable(df)).alias("tie"),
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
    ).withColumn("salt", F.xxhash64("tie", F.monotonically_increasing_id()))

    # Rank within the source: the place among all sources, less the rows of earlier ones.
    placed = dense_keys(rows, ["stratum", "order", "tie", "salt"], 0, "place")
    sizes = placed.groupBy("stratum").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    # Stored, so that the join deals out both sides itself and can split a large source.
    sizes = materialise(sizes, "source-sizes")
    rank = 2 * (F.col("place") - F.col("first")) + 1
    ranked = placed.join(sizes, "stratum").withColumn(
        "frac", rank.cast("double") / (2 * F.col("size")).cast("double")
    )

    # Place in the whole sequence.
    total = sizes.agg(F.sum("size")).first()[0] or 0
    ranked = ranked.select("frac", "stratum", "order", "tie", "salt", "row")
    sequence = dense_keys(ranked, ["frac", "stratum", "order", "tie", "salt"], -1, "position")
    shard = F.expr(f"int((position * {n_shards}L) div {max(total, 1)}L)")
    begin = F.expr(f"(shard * {total}L + {n_shards - 1}L) div {n_shards}L")
    return sequence.withColumn("shard", shard).select("row.*", "shard", (F.col("position") - begin).alias("slot"))
