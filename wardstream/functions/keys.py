"""Hashed keys and change fingerprints."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# How tracked attributes are joined and how NULL is spelled in the fingerprint.
SEPARATOR = "||"
NULL_MARK = "NA"


def natural_key(*parts: str | Column) -> Column:
    """One text per distinct tuple: each part is length-prefixed, NULL is ``-``."""
    def field(part):
        text = (F.col(part) if isinstance(part, str) else part).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat(*(field(p) for p in parts))


def hashed_key(*parts: str | Column) -> Column:
    """60-bit BIGINT key of a natural key: needs no state, no shuffle, and replays identically.

    Two of n keys collide with probability about n**2 / 2**61, negligible up to some 10**8 keys.
    Larger key sets use :func:`wardstream.operators.keys.dense_keys`.
    """
    digits = F.substring(F.sha2(natural_key(*parts), 256), 1, 15)
    # Never NULL, but only the coalesce tells the planner: a join on the key then adds no null
    # filter, which would compute the hash a second time.
    return F.coalesce(F.conv(digits, 16, 10).cast("bigint"), F.lit(0))


def tracked_text(attrs: Sequence[str | Column], null_safe: bool = False) -> Column:
    """The text two versions are compared by.

    The default form spells NULL as ``NA``, so a NULL and the text ``NA`` count as equal.
    ``null_safe`` keeps them apart.
    """
    if null_safe:
        return natural_key(*attrs)
    parts = [(F.col(a) if isinstance(a, str) else a).cast("string") for a in attrs]
    return F.concat_ws(SEPARATOR, *(F.coalesce(p, F.lit(NULL_MARK)) for p in parts))


def fingerprint(attrs: Sequence[str | Column], null_safe: bool = False) -> Column:
    """SHA-256 of the tracked attributes, as hex."""
    return F.sha2(tracked_text(attrs, null_safe), 256)
