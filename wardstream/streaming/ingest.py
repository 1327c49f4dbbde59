"""Bronze and silver streams: decode and clean, append to a table, resume from a checkpoint."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wardstream.operators import clean


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = False,
    trigger: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Append ``rows`` to the table at ``path``, each input row exactly once.

    ``available_now`` takes what is there and stops; ``trigger`` is a processing interval; with
    neither, batches follow each other without pause. With Parquet, columns added later need
    ``mergeSchema`` when the table is read; a format that merges on write takes it in ``options``.
    """
    writer = (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger is not None:
        writer = writer.trigger(processingTime=trigger)
    return writer.start(path)


def start_bronze(wire: DataFrame, path: str, checkpoint: str, as_of=None, **kw) -> StreamingQuery:
    """Broker rows into the raw table."""
    return append_stream(clean.bronze_decode(wire, as_of), path, checkpoint, **kw)


def start_silver(
    bronze: DataFrame, path: str, checkpoint: str, as_of=None, dq: str | None = None, **kw
) -> StreamingQuery:
    """Raw table into the clean table: one narrow stage per batch, no state.

    With ``dq``, each batch's rule violations appear under that name in its progress report.
    """
    return append_stream(clean.clean_events(bronze, as_of, dq), path, checkpoint, **kw)


def start_quarantine(bronze: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Raw text of rows that cannot be used, into a table of its own."""
    return append_stream(clean.rejected_input(bronze), path, checkpoint, **kw)
