"""Reports on the silver stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardstream.sources.snapshot import _COMPLETE
from wardstream.sources.tables import matching_paths, remove_path
from wardstream.streaming.owner import claim, mark

_CLOCK = "_event_time"
#: Sketches of distinct patients have 2^12 registers.
SKETCH = 12


def with_event_time(rows: DataFrame, delay: str, time: str = "admission_time") -> DataFrame:
    """Add the watermark. It needs TIMESTAMP, so run under session time zone UTC."""
    return rows.withColumn(_CLOCK, F.col(time).cast("timestamp")).withWatermark(_CLOCK, delay)


def dedup_events(
    rows: DataFrame, delay: str, key: str = "event_id", time: str = "arrived_at"
) -> DataFrame:
    """Drop redelivered events; state is kept only as long as the watermark allows.

    The watermark follows the arrival, which moves on with the stream whatever the events tell of, so an
    event is late only if it arrives ``delay`` out of order. Redeliveries farther apart than
    that pass: choose it above the broker's redelivery time.
    """
    marked = with_event_time(rows, delay, time)
    return marked.dropDuplicatesWithinWatermark([key]).drop(_CLOCK)


def admission_trend(
    rows: DataFrame, delay: str, window: str = "1 hour", time: str = "admission_time"
) -> DataFrame:
    """Admissions per window and gender, each window once, when the watermark has passed it.

    Admissions more than ``delay`` behind the newest are left out, so the delay must cover how far back
    events may tell of; where that is not known, use :func:`start_trend`, which counts every
    admission. Use it after the admission clamp: an admission in the future would carry the watermark
    with it and make every regular event late.
    """
    marked = with_event_time(rows, delay, time)
    counted = marked.groupBy(F.window(_CLOCK, window), "gender").agg(
        F.count(F.lit(1)).alias("admissions")
    )
    return counted.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "gender",
        "admissions",
    )


#: So many folders of a tier are added up into one of the next.
TIER = 32
_COUNTS = "window_start timestamp_ntz, gender string, admissions bigint, newest timestamp_ntz, patients binary"


def _folders(spark: SparkSession, path: str) -> dict[tuple[int, int], str]:
    """The complete folders: first and last batch, and path."""
    done = matching_paths(spark, f"{path}/from=*/to=*/_SUCCESS")
    found = {}
    for p in done:
        folder = p.rsplit("/", 1)[0]
        first, last = (int(x.split("=")[1]) for x in folder.split("/")[-2:])
        found[first, last] = folder
    return found


def _cover(ranges) -> list[tuple[int, int]]:
    """The widest ranges that hold each batch once."""
    out, covered = [], -1
    for first, last in sorted(ranges, key=lambda r: (r[0], -r[1])):
        if first > covered:
            out.append((first, last))
            covered = last
    return out


def _write_counts(counted: DataFrame, path: str, first: int, last: int) -> None:
    writer = counted.write.options(**_COMPLETE).mode("overwrite")
    writer.parquet(f"{path}/from={first}/to={last}")


def _added_up(parts: DataFrame) -> DataFrame:
    return parts.groupBy("window_start", "gender").agg(
        F.sum("admissions").alias("admissions"),
        F.max("newest").alias("newest"),
        F.hll_union_agg("patients").alias("patients"),
    )


def _fold(spark: SparkSession, path: str, number: int, tier: int) -> None:
    """Add up folders into wider ones where batch ``number`` completes a range, and remove what ranges completed
    before have replaced: a reader who listed those has had a range's time to read them."""
    size = tier
    while (number + 1) % size == 0:
        held, first = _folders(spark, path), number + 1 - size
        inside = _cover(r for r in held if first <= r[0] and r[1] <= number and r != (first, number))
        parts = spark.read.schema(_COUNTS).parquet(*(held[r] for r in inside))
        _write_counts(_added_up(parts), path, first, number)
        size *= tier
    if size > tier:
        held = _folders(spark, path)
        live = set(_cover(held))
        for (first, last), folder in held.items():
            if (first, last) not in live and not any(a <= first and b == number for a, b in live):
                remove_path(spark, folder)


def start_trend(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    window: str = "hour",
    time: str = "admission_time",
    available_now: bool = False,
    trigger: str | None = None,
    tier: int = TIER,
) -> StreamingQuery:
    """Keep the counts that :func:`read_trend` adds up; every admission counts once, however late.

    Each micro-batch leaves its own counts per window (a unit of time, as ``hour``) and gender, and a sketch of the distinct
    patients, in a folder of its number, so a batch replayed after a crash replaces what it left. Every ``tier``
    folders are added up into one, and so are every ``tier`` of those: the number of folders grows with the logarithm of the number of
    batches. A batch that such a folder holds already is not counted again. No state is held.

    A checkpoint numbers its batches from 0, so counts belong to one checkpoint: another one, or one started anew, raises.
    """
    spark = rows.sparkSession
    claim(spark, path, checkpoint, "from=*")

    def count(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if any(first <= number <= last and first < last for first, last in _folders(session, path)):
            return  # replayed after it was added up
        counted = batch.groupBy(
            F.date_trunc(window, time).cast("timestamp_ntz").alias("window_start"), "gender"
        ).agg(
            F.count(F.lit(1)).alias("admissions"),
            F.max(time).alias("newest"),
            F.hll_sketch_agg("patient_id", F.lit(SKETCH)).alias("patients"),
        )
        _write_counts(counted, path, number, number)
        _fold(session, path, number, tier)

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(count)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger is not None:
        writer = writer.trigger(processingTime=trigger)
    query = writer.start()
    mark(spark, path, query.id)
    return query


def read_trend(
    spark: SparkSession,
    path: str,
    window: str = "1 hour",
    delay: str | None = None,
    patients: bool = False,
) -> DataFrame:
    """The counts so far per window and gender. ``delay``: only windows that ended so long before the
    newest admission; their counts still grow if later ones come.

    ``patients``: also the number of distinct patients of each window, estimated from sketches: the standard error is 1.6 %, and
    some hundred patients are counted without one. The order in which batches came makes no difference.
    """
    held = _folders(spark, path)
    paths = [held[r] for r in _cover(held)]
    parts = spark.read.schema(_COUNTS).parquet(*paths) if paths else spark.createDataFrame([], _COUNTS)
    end = F.col("window_start") + F.expr(f"INTERVAL {window}")
    counted = _added_up(parts) if patients else parts.groupBy("window_start", "gender").agg(
        F.sum("admissions").alias("admissions")
    )
    distinct = [F.hll_sketch_estimate("patients").alias("patients")] if patients else []
    counted = counted.select(
        "window_start", end.alias("window_end"), "gender", "admissions", *distinct
    )
    if delay is None:
        return counted
    newest = parts.agg(F.max(F.date_trunc("millisecond", "newest")).cast("timestamp_ntz").alias("newest"))
    # One row.
    closed = F.col("window_end") <= F.col("newest") - F.expr(f"INTERVAL {delay}")
    return counted.join(F.broadcast(newest), closed).drop("newest")


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped for lateness over the progress reports the query still holds."""
    return sum(
        op["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for op in progress["stateOperators"]
    )
