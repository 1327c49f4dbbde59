"""The clock and time parsing. Operators take ``as_of``; only ``now`` reads the wall clock."""

from datetime import UTC, datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# A zone or offset after the time of day: Z, +02:00, -0800, UTC, Europe/Berlin.
_ZONED = (
    r"\d:\d+(:\d+(\.\d+)?)?\s*"
    r"(Z|[A-Za-z]{2,}[A-Za-z_/]*([+-]\d.*)?|[+-]\d{1,2}(:?\d{2}){0,2})\s*$"
)
# Years an event may have. Other times are as good as missing.
FIRST_YEAR, LAST_YEAR = 1900, 2199
# A calendar year in front; a bare time of day is not an event time.
_DATED = r"^\s*[+-]?\d{4,6}(-|\s*$)"


def now(as_of: datetime | str | Column | None = None) -> Column:
    """``as_of`` as a UTC wall-clock column; the current time when none is given.

    Inside a streaming micro-batch the current time is one value per batch.
    """
    if as_of is None:
        return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime) and as_of.tzinfo is not None:
        as_of = as_of.astimezone(UTC).replace(tzinfo=None)
    return F.lit(str(as_of)).cast("timestamp_ntz")


def read_clock(spark: SparkSession, as_of: datetime | str | None = None) -> datetime | str:
    """``as_of``, or one reading of the clock for a job whose parts must agree on the time."""
    return spark.range(1).select(now()).first()[0] if as_of is None else as_of


def parse_time(raw: str | Column) -> Column:
    """ISO-8601 text as a UTC wall-clock timestamp; NULL when it cannot be read.

    Text without a zone is taken as UTC. Text with one is converted to UTC whatever the session
    time zone is, since casting such text to TIMESTAMP_NTZ would drop the offset. Times outside the
    years FIRST_YEAR to LAST_YEAR are NULL too, and so count as missing.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    wall = raw.try_cast("timestamp_ntz")
    instant = raw.try_cast("timestamp").cast("timestamp_ntz")
    utc = F.when(
        raw.rlike(_DATED), F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant)
    )
    # The pattern costs more than both casts; plain text, ending in a digit and without a sign
    # after the date, never reaches it.
    plain = (
        F.substring(raw, -1, 1).between("0", "9")
        & (F.instr(raw, "+") == 0)
        & (F.locate("-", raw, 12) == 0)
    )
    read = F.when(plain, wall).when(raw.rlike(_ZONED), utc).otherwise(wall)
    return F.when(F.year(read).between(FIRST_YEAR, LAST_YEAR), read)


def hours_between(start: str, end: str) -> Column:
    """Whole seconds from ``start`` to ``end``, in hours."""
    return (F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))) / F.lit(3600.0)
