"""Line de-duplication by winnowing over line hashes.

A run of lines that occurs before (in an earlier document, or earlier in its own) is deleted where it occurs again.
Documents are in the order of their key. Long lines weigh more: a line counts as one unit for every ``unit`` words begun,
``run`` at the most, and a run is long enough with ``run`` units; a line without words counts for nothing and stays. So with the
default of 5 units of 10 words, five short lines are a run, and any whole lines of over 40 words in all are one.

Units are hashed in grams of ``gram``, and of each ``run`` units in a row winnowing keeps the least gram hash (the rightmost of
equals), so equal runs keep equal fingerprints. Only fingerprints found at two places or more are followed up: there the match
is extended both ways, over every run that holds the fingerprint, and runs whose first occurrence is
elsewhere go. Occurrences meet through the first one, a minimum for each run that is taken before the
shuffle, and never in pairs, so a passage that a third of all documents share costs a few rows for each of them.

Passages inside of lines are not looked for: lines are hashed whole.

Only DataFrame functions are used. Hashes stand for the lines: two of 64 bits for a line, and two made of them for a run.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstream.llm.common import fresh, rows_and_files
from wardstream.session import materialise

_SALT = 7


def _units(text: Column, unit: int, run: int) -> Column:
    """The units of a text: line number and two hashes."""
    lines = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n", -1),
        lambda x, i: F.struct(
            i.alias("line"),
            F.xxhash64(x).alias("h"),
            F.xxhash64(F.lit(_SALT), x).alias("g"),
            F.least(
                F.lit(run), F.ceil(F.regexp_count(x, F.lit(r"[^\x09-\x0D\x20]+")) / unit)
            ).cast("int").alias("n"),
        ),
    )
    return F.flatten(
        F.transform(
            F.filter(lines, lambda x: x["n"] > 0),
            lambda x: F.transform(
                F.sequence(F.lit(1), x["n"]),
                lambda j: F.struct(x["line"].alias("line"), F.xxhash64(x["h"], j).alias("h"), F.xxhash64(x["g"], j).alias("g")),
            ),
        )
    )


def _steps(count: Column) -> Column:
    """0 to count - 1."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>")
    )


def _fingerprints(docs: DataFrame, unit: int, run: int, gram: int) -> DataFrame:
    """From (key, text_hash, text): a row for each window minimum, with the runs that hold it."""
    window = run - gram + 1

    def joined(i: Column, n: int, h: str = "h") -> list[Column]:
        return [F.get("units", i + j)[h] for j in range(n)]

    units = docs.select("key", "text_hash", _units(F.col("text"), unit, run).alias("units"))
    hashed = units.select(
        "key",
        "text_hash",
        F.transform(
            _steps(F.size("units") - (gram - 1)),
            lambda i: F.struct(F.xxhash64(*joined(i, gram)).alias("h"), (-i).alias("back")),
        ).alias("grams"),
        F.transform(
            _steps(F.size("units") - (run - 1)),
            lambda i: F.struct(
                F.xxhash64(*joined(i, run)).alias("h1"),
                F.xxhash64(*joined(i, run, "g")).alias("h2"),
                i.alias("at"),
                F.get("units", i)["line"].alias("first"),
                F.get("units", i + (run - 1))["line"].alias("last"),
            ),
        ).alias("runs"),
    )
    # The least hash, and of equal ones the rightmost, which has the least negative place.
    minima = F.array_distinct(
        F.transform(
            _steps(F.size("grams") - (window - 1)),
            lambda i: F.array_min(F.slice("grams", i + 1, window)),
        )
    )
    low = F.greatest(-F.col("m.back") - (window - 1), F.lit(0))
    high = F.least(-F.col("m.back"), F.size("runs") - 1)
    return (
        hashed.select("key", "text_hash", "runs", F.explode(minima).alias("m"))
        .select("key", "text_hash", F.col("m.h").alias("fingerprint"), F.slice("runs", low + 1, high - low + 1).alias("runs"))
    )


def repeated_lines(
    docs: DataFrame, key: str, text: str, unit: int = 10, run: int = 5, gram: int = 2
) -> DataFrame:
    """For each document with later occurrences: ``key``, ``text_hash`` (xxhash64) and ``lines``, the sorted line
    numbers, from 0, to delete."""
    if not 1 <= gram <= run:
        raise ValueError("gram must be from 1 to run")
    rows = docs.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    )
    _, files = rows_and_files(rows, "text")
    # Stored: texts are hashed once, and with both sides stored the join deals them out itself and can split a fingerprint of many
    # places.
    found = materialise(_fingerprints(rows, unit, run, gram), "fingerprints")
    often = found.groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    often = materialise(often, "shared-fingerprints", files)
    runs = materialise(
        found.join(often, "fingerprint")
        .select("key", "text_hash", F.explode("runs").alias("r"))
        .select("key", "text_hash", "r.*"),
        "runs",
        files,
    )
    place = F.struct("key", "text_hash", "at")
    first = runs.groupBy("h1", "h2").agg(F.min(place).alias("origin"), F.max(place).alias("end"))
    # Stored, so that the join deals out both sides itself and can split a run of many places.
    first = materialise(first.filter(F.col("origin") != F.col("end")).drop("end"), "first-runs", files)
    later = runs.join(first, ["h1", "h2"]).filter(place != F.col("origin"))
    lines = F.array_distinct(
        F.flatten(F.transform(F.collect_set(F.struct("first", "last")), lambda r: F.sequence(r["first"], r["last"])))
    )
    return later.groupBy("key", "text_hash").agg(F.sort_array(lines).alias("lines"))


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", unit: int = 10, run: int = 5, gram: int = 2
) -> DataFrame:
    """``docs`` with the later occurrences of repeated runs deleted from ``text``, and ``n_lines`` (before) and ``n_deleted``
    (both replaced if there).

    Rows equal in key and text are one document and lose the same lines. Documents of one key are ordered by the hash
    of their texts, and a null key comes first. A null text stays null and has no lines; an empty one
    has one. Deleting all lines leaves an empty text. Lines without words inside a deleted run go with
    it. An empty table stays empty. Other columns are kept as they are.
    """
    kept = docs.drop("n_lines", "n_deleted")
    text_hash, gone = fresh(kept, "text_hash", "gone")
    found = repeated_lines(docs, key, text, unit, run, gram).select(
        F.col("key").alias("found_key"), F.col("text_hash").alias("found_hash"), F.col("lines").alias(gone)
    )
    left = kept.withColumn(text_hash, F.xxhash64(F.col(text))).alias("d")
    same = F.col(f"d.{key}").eqNullSafe(F.col("f.found_key")) & (
        F.col(f"d.{text_hash}") == F.col("f.found_hash")
    )
    lines = F.split(F.col(text), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    cut = F.concat_ws("\n", F.transform(stay, lambda i: F.get(lines, i)))
    joined = left.join(found.alias("f"), same, "left")
    return joined.select(
        *[
            F.when(F.col(gone).isNull(), F.col(f"d.{c}")).otherwise(cut).alias(c)
            if c == text
            else F.col(f"d.{c}")
            for c in kept.columns
        ],
        F.when(F.col(f"d.{text}").isNull(), 0).otherwise(F.size(F.split(F.col(f"d.{text}"), "\n", -1))).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_deleted"),
    )
