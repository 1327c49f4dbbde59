"""Gold tables kept up to date by parts: the work of a refresh follows its rows, not the patients.

A part holds the patients whose hash ends in the same bits. A refresh writes the parts that its rows touch into new folders and leaves
the files of all others alone. One small table, the manifest, names the folder of each part, the departments' folder,
the keys that are free and the clock. It is replaced last and as a whole, so a refresh becomes visible at once: readers of
one manifest see one refresh, and a run that died leaves only folders that no manifest names, which its replay
writes again.

A part that outgrows ``split_rows`` is divided by further bits of the hash when it is next rewritten (extendible
hashing), so the number of parts follows the data. Parts of more than FOLDER_BITS bits share folders, at most 2^FOLDER_BITS a refresh, and those of a
folder are rewritten together: however small parts are, a refresh writes and lists a bounded number of files. What moves with the clock alone, the ingestion time and who is still
admitted, is not stored but computed when the fact is read, as of the last refresh.
"""

from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstream import schemas
from wardstream.functions.clock import now, read_clock
from wardstream.operators import clean, dims, fact, scd2
from wardstream.operators.kpis import Star
from wardstream.operators.latest import latest_by_key, latest_encounter
from wardstream.session import materialise
from wardstream.sources.snapshot import _COMPLETE, SnapshotTable
from wardstream.sources.tables import matching_paths, remove_path

#: Stored beside the columns of a table: the hash of the row's patient.
HASH, PART = "patient_hash", "part"
_PLACE = T.StructType([T.StructField(HASH, T.LongType()), T.StructField(PART, T.LongType())])
#: Parts that go by the same so many bits lie in one folder.
FOLDER_BITS = 8
#: Fact columns that depend on the clock of the refresh.
MOVING = ("is_currently_admitted", "event_ingestion_time")
FACT_KEPT = T.StructType([f for f in schemas.FACT if f.name not in MOVING])
#: A row for each part, and one of part 0 for the whole: the refresh that wrote the departments, the first free key, the clock.
MANIFEST = T.StructType(
    [
        T.StructField("part", T.LongType()),
        T.StructField("refresh", T.LongType()),
        T.StructField("versions", T.LongType()),
        T.StructField("next_key", T.LongType()),
        T.StructField("last_key", T.LongType()),
        T.StructField("as_of", T.TimestampNTZType()),
    ]
)


def depth(part: int) -> int:
    """How many bits of the hash a part goes by: its number is those bits, with a one before them."""
    return part.bit_length() - 1


def folder_of(part: int) -> int:
    """The part that names the folder of ``part``: itself, or the one of FOLDER_BITS bits that it came from."""
    return part if depth(part) <= FOLDER_BITS else (1 << FOLDER_BITS) | part & (1 << FOLDER_BITS) - 1


@dataclass(frozen=True)
class PartState:
    """What the manifest says of a part. The keys ``next_key`` to ``last_key`` are its own to give out."""

    part: int
    refresh: int = 0
    versions: int = 0
    next_key: int = 1
    last_key: int = 0

    def split(self, levels: int) -> list["PartState"]:
        """The parts after dividing by ``levels`` more bits; the first takes the keys over."""
        d, bits = depth(self.part), self.part ^ (1 << depth(self.part))
        return [
            PartState((1 << d + levels) | (high << d) | bits, self.refresh, 0, *((self.next_key, self.last_key) if not high else (1, 0)))
            for high in range(1 << levels)
        ]

    def taking(self, wanted: int, free: int, block: int) -> tuple["PartState", tuple[int, int, int], int]:
        """The state after giving out ``wanted`` keys; the first key, how many follow it, and the key that goes on after them; the
        first free key of all afterwards. Keys come in blocks of ``block``."""
        left = self.last_key - self.next_key + 1
        given = (self.next_key, left, free)
        if wanted <= left:
            return replace(self, next_key=self.next_key + wanted), given, free
        size = -(-(wanted - left) // block) * block
        return replace(self, next_key=free + wanted - left, last_key=free + size - 1), given, free + size


@dataclass(frozen=True)
class State:
    """One manifest: all that a reader or a refresh needs to know."""

    parts: tuple[PartState, ...]
    departments: int = 0
    free_key: int = 1
    as_of: datetime | None = None

    def rows(self) -> list[tuple]:
        whole = (0, self.departments, 0, self.free_key, 0, self.as_of)
        return [whole, *((p.part, p.refresh, p.versions, p.next_key, p.last_key, None) for p in self.parts)]


def _state(rows: list) -> State:
    whole = next(r for r in rows if r.part == 0)
    parts = [PartState(r.part, r.refresh, r.versions, r.next_key, r.last_key) for r in rows if r.part]
    return State(tuple(sorted(parts, key=lambda p: p.part)), whole.refresh, whole.next_key, whole.as_of)


@dataclass
class PartedGold:
    """The gold tables under one folder. One writer at a time.

    ``parts`` is the number of parts at the beginning (rounded up to a power of two); a part with more than ``split_rows`` patient versions is divided.
    ``key_block``: patient versions get exact keys, which parts take from a stored counter in blocks of so many numbers;
    without it keys are 60-bit hashes. With ``keeps_latest`` off, no latest encounters are stored: each row given to
    :meth:`refresh` must be the latest of its patient so far, one a patient. Tables begun in one of these ways go on in it.
    """

    spark: SparkSession
    path: str
    parts: int = 64
    split_rows: int = 2_000_000
    key_block: int | None = None
    keeps_latest: bool = True

    def __post_init__(self):
        self.manifest = SnapshotTable(self.spark, f"{self.path}/manifest", MANIFEST)

    # Reading.

    def state(self) -> State:
        """The last complete refresh; before the first, parts without rows."""
        if not self.manifest.exists():
            first = PartState(1).split((max(self.parts, 1) - 1).bit_length())
            return State(tuple(first))
        return _state(self.manifest.read().collect())  # as many rows as parts

    def folder(self, name: str, refresh: int) -> str:
        return f"{self.path}/{name}/r={refresh}"

    def live(self, state: State, touched: set[int] | None = None) -> list[tuple[int, int]]:
        """The folders that hold rows, of the parts ``touched`` if given: part and refresh."""
        held = {(folder_of(p.part), p.refresh) for p in state.parts if p.versions and (touched is None or p.part in touched)}
        return sorted(held)

    def _read(
        self, name: str, schema: T.StructType, state: State, touched: set[int] | None = None
    ) -> DataFrame:
        """The rows of a table with their places, of the parts ``touched`` if given: all parts of their folders. ``part`` is that of the folder."""
        placed = T.StructType([*schema, *_PLACE])
        held = self.live(state, touched)
        if not held:
            return self.spark.createDataFrame([], placed)
        paths = [f"{self.folder(name, refresh)}/{PART}={part}" for part, refresh in held]
        reader = self.spark.read.schema(placed).option("basePath", f"{self.path}/{name}")
        return reader.parquet(*paths).select(*placed.names)

    def departments(self, state: State | None = None) -> DataFrame:
        state = state or self.state()
        if not state.departments:
            return self.spark.createDataFrame([], schemas.DIM_DEPARTMENT)
        return self.spark.read.schema(schemas.DIM_DEPARTMENT).parquet(
            self.folder("dim_department", state.departments)
        )

    def patients(self, state: State | None = None) -> DataFrame:
        rows = self._read("dim_patient", schemas.DIM_PATIENT, state or self.state())
        return rows.select(*schemas.DIM_PATIENT.names)

    def fact(self, state: State | None = None) -> DataFrame:
        """The facts as of the last refresh."""
        state = state or self.state()
        kept = self._read("fact_patient_flow", FACT_KEPT, state)
        clock = F.lit(None).cast("timestamp_ntz") if state.as_of is None else now(state.as_of)
        admitted = F.coalesce(F.col("discharge_time") > clock, F.lit(False))
        return kept.withColumns(
            {"is_currently_admitted": admitted, "event_ingestion_time": clock}
        ).select(*schemas.FACT.names)

    def star(self) -> Star:
        """All tables as of one refresh."""
        state = self.state()
        return Star(self.fact(state), self.patients(state), self.departments(state))

    def _state_of(self, version: int) -> State:
        rows = self.spark.read.schema(MANIFEST).parquet(self.manifest.folder(version)).collect()
        return _state(rows)

    def tidy(self, keep: int = 2) -> int:
        """Remove what only manifests older than the last ``keep`` name, and what runs that died have left; returns how many folders.

        Readers who began before those refreshes lose their files, so keep as many as refresh while a report runs. Not while a refresh runs.
        """
        last = self.manifest.version()
        held = matching_paths(self.spark, f"{self.manifest.path}/v=*")
        versions = sorted(int(p.rsplit("=", 1)[1]) for p in held)
        kept = [v for v in versions if last - keep < v <= last]
        states = [self._state_of(v) for v in kept]
        live = {f"r={p.refresh}/{PART}={folder_of(p.part)}" for s in states for p in s.parts}
        live |= {f"r={s.departments}" for s in states}
        gone = [p for p in held if int(p.rsplit("=", 1)[1]) not in kept]
        for name in ("latest", "dim_patient", "fact_patient_flow"):
            found = matching_paths(self.spark, f"{self.path}/{name}/r=*/{PART}=*")
            gone += [p for p in found if "/".join(p.rsplit("/", 2)[1:]) not in live]
        found = matching_paths(self.spark, f"{self.path}/dim_department/r=*")
        gone += [p for p in found if p.rsplit("/", 1)[1] not in live]
        for p in gone:
            remove_path(self.spark, p)
        return len(gone)

    # Writing.

    def refresh(self, silver: DataFrame, as_of: datetime | str | None = None) -> list[int]:
        """Bring the tables up to date with new rows of silver; returns the parts written.

        A refresh that died at any step has changed nothing that readers see, and is repeated as if it had not
        begun. Repeating one that was complete changes nothing but the clock.
        """
        as_of = read_clock(self.spark, as_of)
        state, number = self.state(), self.manifest.version() + 1
        rows = clean.accepted(silver).select(*schemas.SILVER.names)
        arrived = rows if not self.keeps_latest else latest_encounter(rows)
        arrived = materialise(self._placed(arrived, state), "parts-arrived")
        # As many numbers as parts at the most.
        touched = {r.part for r in arrived.select(PART).distinct().collect()}
        folders = {folder_of(p) for p in touched}
        touched = {p.part for p in state.parts if folder_of(p.part) in folders}
        if touched:
            state = self._refresh_parts(arrived, touched, state, number, as_of)
        clock = self.spark.range(1).select(now(as_of).alias("as_of")).first().as_of
        entries = self.spark.createDataFrame(replace(state, as_of=clock).rows(), MANIFEST)
        self.manifest.replace(entries.coalesce(1))
        return sorted(p.part for p in state.parts if p.refresh == number)

    def _placed(self, rows: DataFrame, state: State) -> DataFrame:
        """``rows`` with the hash of their patient and their part."""
        bits = max(depth(p.part) for p in state.parts)
        slots = []
        for p in state.parts:
            d = depth(p.part)
            slots += [(p.part ^ (1 << d) | high << d, p.part) for high in range(1 << bits - d)]
        directory = self.spark.createDataFrame(slots, f"slot long, {PART} long")
        hashed = rows.withColumn(HASH, F.xxhash64("patient_id"))
        slot = F.col(HASH).bitwiseAND((1 << bits) - 1)
        return hashed.withColumn("slot", slot).join(directory, "slot").drop("slot")

    def _write(self, name: str, rows: DataFrame, schema: T.StructType, number: int) -> None:
        """Few files for each folder, and one with many rows spread over tasks."""
        part = F.col(PART)
        short = F.lit(1 << FOLDER_BITS).bitwiseOR(part.bitwiseAND((1 << FOLDER_BITS) - 1))
        (
            rows.select(*schema.names, *_PLACE.names)
            .withColumn(PART, F.when(part >= 2 << FOLDER_BITS, short).otherwise(part))
            .hint("rebalance", PART)
            .write.partitionBy(PART)
            .options(**_COMPLETE)
            .mode("overwrite")
            .parquet(self.folder(name, number))
        )

    def _refresh_parts(self, arrived: DataFrame, touched: set[int], state: State, number: int, as_of) -> State:
        changed, latest = arrived, None
        if self.keeps_latest:
            held = self._read("latest", schemas.SILVER, state, touched).withColumn("new", F.lit(False))
            both = held.unionByName(arrived.withColumn("new", F.lit(True)))
            order = ["admission_time", "arrived_at", "event_id"]
            latest = materialise(latest_by_key(both, "patient_id", order), "parts-latest")
            # Where the row held before wins, nothing of the patient changes.
            changed = latest.filter("new")

        held = self._read("dim_patient", schemas.DIM_PATIENT, state, touched)
        versions = scd2.scd2_apply(
            held, scd2.incoming_patients(changed), as_of, hashed=self.key_block is None
        )
        versions = materialise(self._placed(versions, state), "parts-versions")
        sizes = {r.part: r.n for r in versions.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()}
        levels = {p: self._levels(n) for p, n in sizes.items()}
        versions = self._divided(versions, levels)
        counted = versions.groupBy(PART).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("surrogate_key").isNull()).alias("unnumbered")
        )
        counts = {r.part: r for r in counted.collect()}

        after, given, free = [], [], state.free_key
        for p in state.parts:
            if p.part not in touched:
                after.append(p)
                continue
            for q in p.split(levels.get(p.part, 0)):
                n, wanted = (counts[q.part].n, counts[q.part].unnumbered) if q.part in counts else (0, 0)
                if wanted:
                    q, keys, free = q.taking(wanted, free, self.key_block)
                    given.append((q.part, *keys))
                after.append(replace(q, refresh=number, versions=n))
        versions = self._numbered(versions, given)
        if latest is not None:
            self._write("latest", self._divided(latest, levels), schemas.SILVER, number)
        self._write("dim_patient", versions, schemas.DIM_PATIENT, number)
        after_state = State(tuple(sorted(after, key=lambda p: p.part)), number, free)

        departments = self.departments(state).unionByName(dims.dim_department(changed)).distinct()
        departments.write.options(**_COMPLETE).mode("overwrite").parquet(
            self.folder("dim_department", number)
        )
        self._write_facts(changed, touched, held, levels, state, after_state, number, as_of)
        return after_state

    def _write_facts(
        self, changed: DataFrame, touched: set[int], held: DataFrame, levels: dict, before: State, after: State, number: int, as_of
    ) -> None:
        """Facts of the parts: those of changed patients are made anew, the others stay as they are."""
        mine = {p.part for p in after.parts if p.refresh == number}
        patients = self._read("dim_patient", schemas.DIM_PATIENT, after, mine)
        made = fact.fact_patient_flow(
            changed, patients.drop(*_PLACE.names), self.departments(after), as_of, keep=_PLACE.names
        )
        # A stored fact has the key of what was the current version.
        gone = held.filter("is_current").join(changed.select("patient_id"), "patient_id", "left_semi")
        facts = self._read("fact_patient_flow", FACT_KEPT, before, touched)
        kept = facts.join(gone.select(F.col("surrogate_key").alias("patient_sk")), "patient_sk", "left_anti")
        names = [*FACT_KEPT.names, *_PLACE.names]
        rows = kept.select(*names).unionByName(made.select(*names))
        self._write("fact_patient_flow", self._divided(rows, levels), FACT_KEPT, number)

    def _levels(self, n: int) -> int:
        """By how many more bits a part of ``n`` versions is divided."""
        return (-(-n // self.split_rows) - 1).bit_length() if n > self.split_rows else 0

    def _divided(self, rows: DataFrame, levels: dict[int, int]) -> DataFrame:
        """``rows``, those of divided parts in their new ones."""
        wider = [(p, depth(p) + n) for p, n in levels.items() if n]
        if not wider:
            return rows
        bits = self.spark.createDataFrame(wider, f"{PART} long, bits int")
        moved = F.expr(f"shiftleft(1L, bits) | ({HASH} & (shiftleft(1L, bits) - 1L))")
        return rows.join(bits, PART, "left").withColumn(PART, F.coalesce(moved, F.col(PART))).drop("bits")

    def _numbered(self, versions: DataFrame, given: list[tuple[int, int, int, int]]) -> DataFrame:
        """``versions``, those without a key numbered in patient order within their part, whose size is bounded."""
        if not given:
            return versions
        keys = self.spark.createDataFrame(given, f"{PART} long, own long, many long, further long")
        unnumbered = versions.filter("surrogate_key IS NULL")
        place: Column = F.row_number().over(Window.partitionBy(PART).orderBy("patient_id"))
        key = F.when(F.col("place") <= F.col("many"), F.col("own") + F.col("place") - 1).otherwise(
            F.col("further") + F.col("place") - F.col("many") - 1
        )
        numbered = unnumbered.withColumn("place", place.cast("long")).join(keys, PART)
        numbered = numbered.withColumn("surrogate_key", key).select(*versions.columns)
        return versions.filter("surrogate_key IS NOT NULL").unionByName(numbered)
