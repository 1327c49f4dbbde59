"""Type-2 patient dimension: set-based, one pass, no keys on the driver.

``target`` is a dimension in the ``DIM_PATIENT`` contract. ``incoming`` holds one row per patient
(``patient_id`` and the tracked attributes); :func:`incoming_patients` makes it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstream import schemas
from wardstream.functions.clock import now
from wardstream.functions.keys import fingerprint, hashed_key, tracked_text
from wardstream.operators.keys import dense_keys
from wardstream.operators.latest import latest_by_key
from wardstream.session import materialise

COLUMNS = schemas.DIM_PATIENT.names


def incoming_patients(latest: DataFrame) -> DataFrame:
    """Dimension input from the latest encounters."""
    return latest.select("patient_id", *schemas.TRACKED)


def attr_fingerprint(df: DataFrame, null_safe: bool = False, name: str = "attr_hash") -> DataFrame:
    """Add the change fingerprint of the tracked attributes."""
    return df.withColumn(name, fingerprint(schemas.TRACKED, null_safe))


def current_versions(target: DataFrame) -> DataFrame:
    return target.filter("is_current")


def _key(patient: str, as_of, hashed: bool) -> Column:
    """Key of a version opened at the clock; NULL when it is numbered afterwards."""
    return hashed_key(patient, now(as_of)) if hashed else F.lit(None).cast("bigint")


def _never() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def _opened(rows: DataFrame, as_of, hashed: bool = True) -> DataFrame:
    return (
        rows.select("patient_id", *schemas.TRACKED)
        .withColumn("effective_from", now(as_of))
        .withColumn("surrogate_key", _key("patient_id", as_of, hashed))
        .withColumn("effective_to", _never())
        .withColumn("is_current", F.lit(True))
        .select(*COLUMNS)
    )


def scd2_init(incoming: DataFrame, as_of=None, hashed: bool = True) -> DataFrame:
    """First load: every patient becomes a current version."""
    return _opened(incoming.filter("patient_id IS NOT NULL"), as_of, hashed)


def _differs(left: str, right: str, null_safe: bool) -> Column:
    """Tracked attributes differ. Comparing the text decides what comparing its hash would."""
    def text(side):
        return tracked_text([F.col(f"{side}.{a}") for a in schemas.TRACKED], null_safe)

    return text(left) != text(right)


def scd2_changes(target: DataFrame, incoming: DataFrame, null_safe: bool = False) -> DataFrame:
    """Current versions whose tracked attributes changed: ``(surrogate_key, patient_id)``."""
    return (
        current_versions(target).alias("t")
        .join(incoming.alias("i"), F.col("t.patient_id") == F.col("i.patient_id"))
        .filter(_differs("t", "i", null_safe))
        .select("t.surrogate_key", "t.patient_id")
    )


def scd2_new_keys(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Patients without a current version."""
    known = current_versions(target).select("patient_id")
    return incoming.filter("patient_id IS NOT NULL").join(known, "patient_id", "left_anti")


def scd2_close(target: DataFrame, incoming: DataFrame, as_of=None, null_safe=False) -> DataFrame:
    """The changed current versions, closed at the clock."""
    changed = scd2_changes(target, incoming, null_safe).select("surrogate_key")
    return (
        current_versions(target)
        .join(changed, "surrogate_key", "left_semi")
        .withColumns({"effective_to": now(as_of), "is_current": F.lit(False)})
        .select(*COLUMNS)
    )


def scd2_inserts(target: DataFrame, incoming: DataFrame, as_of=None, null_safe=False) -> DataFrame:
    """Versions to add: patients that are new, or whose tracked attributes changed."""
    joined = (
        incoming.filter("patient_id IS NOT NULL").alias("i")
        .join(
            current_versions(target).alias("t"),
            F.col("i.patient_id") == F.col("t.patient_id"),
            "left",
        )
        .filter(F.col("t.patient_id").isNull() | _differs("t", "i", null_safe))
    )
    return _opened(joined.select("i.*"), as_of)


def merge_current(
    current: DataFrame,
    incoming: DataFrame,
    as_of=None,
    null_safe: bool = False,
    hashed: bool = True,
) -> DataFrame:
    """Current versions after ``incoming``, together with the versions it closed.

    One full outer join on the patient: each side holds a patient once, so each is shuffled once
    and no key is hot. A pair yields the kept version, the opened one, or closed and opened.
    """
    known = F.col("t.patient_id").isNotNull()
    arrived = F.col("i.patient_id").isNotNull()
    changed = known & arrived & _differs("t", "i", null_safe)

    def version(**values: Column) -> Column:
        return F.struct(*(values[c].alias(c) for c in COLUMNS))

    held = {c: F.col(f"t.{c}") for c in COLUMNS}
    kept = version(**held)
    closed = version(**held | {"effective_to": now(as_of), "is_current": F.lit(False)})
    opened = version(
        patient_id=F.col("i.patient_id"),
        **{a: F.col(f"i.{a}") for a in schemas.TRACKED},
        effective_from=now(as_of),
        surrogate_key=_key("i.patient_id", as_of, hashed),
        effective_to=_never(),
        is_current=F.lit(True),
    )
    return (
        current.alias("t")
        .join(
            incoming.filter("patient_id IS NOT NULL").alias("i"),
            F.col("t.patient_id") == F.col("i.patient_id"),
            "full_outer",
        )
        .select(
            F.inline(
                F.when(changed, F.array(closed, opened))
                .when(known, F.array(kept))
                .otherwise(F.array(opened))
            )
        )
    )


def scd2_apply(
    target: DataFrame, incoming: DataFrame, as_of=None, null_safe: bool = False, hashed: bool = True
) -> DataFrame:
    """The whole dimension after ``incoming``. Closed history passes through unshuffled.

    Patients absent from ``incoming`` stay as they are. ``target`` is read twice, so pass a
    stored table, not a long chain of earlier applies. Without ``hashed``, opened versions have no key yet.
    """
    merged = merge_current(current_versions(target), incoming, as_of, null_safe, hashed)
    return target.filter("NOT is_current").select(*COLUMNS).unionByName(merged)


def with_dense_keys(versions: DataFrame, start: int) -> DataFrame:
    """Number the versions that have no key yet from ``start + 1``, in patient order.

    ``start`` is the greatest key in use. Made for ``hashed=False`` results, which hold one
    unnumbered version per patient at most.
    """
    stored = materialise(versions, "scd2-versions")
    unnumbered = stored.filter("surrogate_key IS NULL").drop("surrogate_key")
    numbered = dense_keys(unnumbered, ["patient_id"], start)
    return stored.filter("surrogate_key IS NOT NULL").unionByName(numbered).select(*COLUMNS)


def scd2_history(batches: DataFrame, batch_time: str = "batch_time") -> DataFrame:
    """Back-fill: all versions implied by many batches of encounters at once.

    Equals applying the batches in order. Each patient is first cut to one row per batch, map
    side too, so the window over a patient is bounded by the number of batches.
    """
    per_batch = latest_by_key(
        batches.filter("patient_id IS NOT NULL"),
        ["patient_id", batch_time],
        ["admission_time", "event_id"],
    )
    by_time = Window.partitionBy("patient_id").orderBy(batch_time)
    text = tracked_text(schemas.TRACKED)
    starts = per_batch.withColumn("_before", F.lag(text).over(by_time)).filter(
        F.col("_before").isNull() | (F.col("_before") != text)
    )
    until = F.lead(batch_time).over(by_time)
    return starts.select(
        "patient_id",
        *schemas.TRACKED,
        F.col(batch_time).alias("effective_from"),
        hashed_key("patient_id", batch_time).alias("surrogate_key"),
        until.alias("effective_to"),
        until.isNull().alias("is_current"),
    )
