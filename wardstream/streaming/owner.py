"""Tables whose folders are named by micro-batch belong to one checkpoint."""

import json

from pyspark.sql import SparkSession

from wardstream.sources.tables import matching_paths, touch_path


def claim(spark: SparkSession, path: str, checkpoint: str, held: str) -> None:
    """Raise if ``path`` has folders ``held`` (a glob) that the stream of ``checkpoint`` did not leave: its batches would
    have the same numbers as those of another one."""
    if not matching_paths(spark, f"{path}/{held}"):
        return
    known = matching_paths(spark, f"{checkpoint}/metadata")
    own = json.loads(spark.read.text(known[0]).first().value)["id"] if known else None
    owners = {p.rsplit("-owner-", 1)[1] for p in matching_paths(spark, f"{path}/_stream-owner-*")}
    if own is None or owners and own not in owners:
        raise ValueError(f"{path} was left by another checkpoint, whose batches have the same numbers")


def mark(spark: SparkSession, path: str, query_id: str) -> None:
    """Note whose folders they are; the id of a query stays the same over restarts from its checkpoint."""
    touch_path(spark, f"{path}/_stream-owner-{query_id}")
