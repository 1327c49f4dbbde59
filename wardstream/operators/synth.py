"""Synthetic encounters at any scale: a pure function of an id column, with known dirt rates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstream.functions.clock import now

# Domains of the generated fields.
DEPARTMENTS = [
    "Emergency",
    "Surgery",
    "ICU",
    "Pediatrics",
    "Maternity",
    "Oncology",
    "Cardiology",
]
GENDERS = ["Male", "Female"]
HOSPITALS = 7
BEDS = 500
STAY_HOURS = 72
DIRTY_PERCENT = 5


def synth_events(ids: DataFrame, id_col: str = "event_id", seed: int = 0, as_of=None) -> DataFrame:
    """One typed event per id. Each field draws from its own four hex digits of one SHA-256.

    About 5 % of ages are above 100 and, independently, 5 % of admissions lie in the future; the
    discharge follows the admission first drawn, so a dirty event may end before it begins.
    """
    ident = F.col(id_col).cast("bigint")
    hexed = ids.select(
        ident.alias("event_id"), F.sha2(F.concat_ws(":", F.lit(seed), ident), 256).alias("_hex")
    )
    # Three 16-bit draws per word: reading hex text is the costly part.
    drawn = hexed.withColumns(
        {
            f"_w{i}": F.conv(F.substring("_hex", 1 + 12 * i, 12), 16, 10).cast("bigint")
            for i in range(4)
        }
    )

    def draw(slot: int, n: int) -> Column:
        bits = F.shiftright(f"_w{slot // 3}", 16 * (2 - slot % 3)).bitwiseAND(0xFFFF)
        return (bits % n).cast("int")

    def pick(slot: int, values: list[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), draw(slot, len(values)) + 1)

    def hours(n: Column) -> Column:
        return F.make_dt_interval(hours=n)

    admitted = now(as_of) - hours(draw(4, STAY_HOURS + 1))
    future = now(as_of) + hours(draw(8, STAY_HOURS) + 1)
    return drawn.select(
        "event_id",
        F.substring("_hex", 33, 32).alias("patient_id"),
        pick(1, GENDERS).alias("gender"),
        F.when(draw(6, 100) < DIRTY_PERCENT, draw(7, 50) + 101)
        .otherwise(draw(2, 100) + 1)
        .alias("age"),
        pick(3, DEPARTMENTS).alias("department"),
        F.when(draw(9, 100) < DIRTY_PERCENT, future).otherwise(admitted).alias("admission_time"),
        (admitted + hours(draw(5, STAY_HOURS) + 1)).alias("discharge_time"),
        (draw(10, BEDS) + 1).alias("bed_id"),
        (draw(11, HOSPITALS) + 1).alias("hospital_id"),
        now(as_of).alias("arrived_at"),
    )
