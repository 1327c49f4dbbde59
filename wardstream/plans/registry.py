"""The registered queries: every operator over the whole ``events`` table, at a fixed clock."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstream import schemas
from wardstream.functions.keys import hashed_key
from wardstream.operators import clean, dims, fact, kpis, scd2
from wardstream.operators.keys import dense_keys
from wardstream.operators.latest import latest_encounter
from wardstream.plans import views
from wardstream.plans.gold import Gold, build_star, table_counts
from wardstream.plans.parted import PartedGold
from wardstream.plans.publish import catalogue_star, publish_bucketed
from wardstream.session import materialise, scratch_dir
from wardstream.sources import encounters as src
from wardstream.sources.encounters import AS_OF, FIRST_LOAD
from wardstream.sources.tables import create_external_table, table_stream
from wardstream.streaming import gold as gold_stream
from wardstream.streaming import ingest, once, quality, trend

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Inputs shared by the queries.


def typed(spark, sf_dir) -> DataFrame:
    return src.encounters(src.events(spark, sf_dir))


def faulty(spark, sf_dir) -> DataFrame:
    """Every event, and faulty ones beside them, for the queries that clean."""
    return src.encounters_with_faults(src.events(spark, sf_dir)).drop("fault")


def repaired(rows: DataFrame) -> DataFrame:
    return clean.conform_schema(clean.impute_age(clean.clamp_admission(rows, AS_OF)))


def silver_rows(spark, sf_dir) -> DataFrame:
    return repaired(typed(spark, sf_dir))


def usable(spark, sf_dir) -> DataFrame:
    return clean.accepted(silver_rows(spark, sf_dir))


def star(spark, sf_dir, grain="patient") -> kpis.Star:
    return build_star(silver_rows(spark, sf_dir), AS_OF, grain)


def first_and_second_load(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The dimension after the first load, stored, and the input of the second."""
    rows = usable(spark, sf_dir)
    early = rows.filter(F.col("admission_time") < F.lit(FIRST_LOAD).cast("timestamp_ntz"))
    first = scd2.scd2_init(scd2.incoming_patients(latest_encounter(early)), FIRST_LOAD)
    return materialise(first, "dim"), scd2.incoming_patients(latest_encounter(rows))


# Ingest and cleaning.


@query
def bronze_decode(spark, sf_dir):
    return clean.bronze_decode(src.wire(src.events(spark, sf_dir)), AS_OF)


@query
def parse_events(spark, sf_dir):
    return clean.parse_events(bronze_decode(spark, sf_dir))


@query
def type_times(spark, sf_dir):
    return clean.type_times(parse_events(spark, sf_dir))


@query
def clamp_admission(spark, sf_dir):
    return clean.clamp_admission(faulty(spark, sf_dir), AS_OF)


@query
def impute_age(spark, sf_dir):
    return clean.impute_age(faulty(spark, sf_dir))


@query
def conform_schema(spark, sf_dir):
    return clean.conform_schema(faulty(spark, sf_dir).drop("bed_id", "discharge_time"))


@query
def silver(spark, sf_dir):
    return clean.clean_events(bronze_decode(spark, sf_dir), AS_OF)


@query
def quarantine(spark, sf_dir):
    return clean.quarantine(repaired(faulty(spark, sf_dir))).select(
        "event_id", "department", "admission_time", "reason"
    )


@query
def rejected_input(spark, sf_dir):
    return clean.rejected_input(bronze_decode(spark, sf_dir))


@query
def dq_profile(spark, sf_dir):
    return clean.dq_profile(faulty(spark, sf_dir), AS_OF)


# Keys and dimensions.


@query
def surrogate_key(spark, sf_dir):
    return faulty(spark, sf_dir).select(
        "event_id", hashed_key("patient_id", "admission_time").alias("surrogate_key")
    )


@query
def dense_surrogate_key(spark, sf_dir):
    rows = usable(spark, sf_dir).select("patient_id", "event_id")
    return dense_keys(rows, ["patient_id", "event_id"])


@query
def attr_fingerprint(spark, sf_dir):
    return scd2.attr_fingerprint(
        repaired(faulty(spark, sf_dir)).select("event_id", "gender", "age")
    )


QUERIES["latest_encounter"] = lambda spark, sf_dir: latest_encounter(usable(spark, sf_dir))


@query
def dim_department(spark, sf_dir):
    return dims.dim_department(latest_encounter(usable(spark, sf_dir)))


@query
def scd2_init(spark, sf_dir):
    incoming = scd2.incoming_patients(latest_encounter(usable(spark, sf_dir)))
    return scd2.scd2_init(incoming, AS_OF)


@query
def scd2_new_keys(spark, sf_dir):
    return scd2.scd2_new_keys(*first_and_second_load(spark, sf_dir))


@query
def scd2_changes(spark, sf_dir):
    return scd2.scd2_changes(*first_and_second_load(spark, sf_dir))


@query
def scd2_close(spark, sf_dir):
    return scd2.scd2_close(*first_and_second_load(spark, sf_dir), AS_OF)


@query
def scd2_inserts(spark, sf_dir):
    return scd2.scd2_inserts(*first_and_second_load(spark, sf_dir), AS_OF)


@query
def scd2_apply(spark, sf_dir):
    return scd2.scd2_apply(*first_and_second_load(spark, sf_dir), AS_OF)


@query
def dim_patient_current(spark, sf_dir):
    return scd2.current_versions(scd2_apply(spark, sf_dir))


@query
def scd2_history(spark, sf_dir):
    """One load per day, each at the end of its day."""
    day = F.date_trunc("day", "admission_time").cast("timestamp_ntz")
    rows = clean.accepted(clean.impute_age(typed(spark, sf_dir)))
    return scd2.scd2_history(
        rows.withColumn("batch_time", day + F.make_dt_interval(days=F.lit(1)))
    )


# Fact and gold tables.


@query
def fact_patient_flow(spark, sf_dir):
    return star(spark, sf_dir).fact


@query
def fact_by_visit(spark, sf_dir):
    return star(spark, sf_dir, "visit").fact


@query
def fact_by_date(spark, sf_dir):
    path = scratch_dir(spark, "fact-by-date")
    fact.write_fact_by_date(star(spark, sf_dir).fact, path)
    return fact.read_fact(spark, path)


@query
def ext_table_scan(spark, sf_dir):
    path = scratch_dir(spark, "ext-fact")
    star(spark, sf_dir).fact.write.parquet(path)
    return create_external_table(spark, "ext_fact_patient_flow", schemas.FACT, path)


@query
def dq_table_counts(spark, sf_dir):
    return table_counts(star(spark, sf_dir))


@query
def gold_refresh(spark, sf_dir):
    """The patient dimension after two refreshes of the stored gold tables, densely keyed."""
    gold = Gold(spark, scratch_dir(spark, "gold"))
    rows = silver_rows(spark, sf_dir)
    cut = F.lit(FIRST_LOAD).cast("timestamp_ntz")
    gold.refresh(rows.filter(F.col("admission_time") < cut), FIRST_LOAD)
    gold.refresh(rows.filter(F.col("admission_time") >= cut), AS_OF)
    return gold.patients.read()


@query
def dim_time(spark, sf_dir):
    return dims.dim_time(star(spark, sf_dir).fact)


# KPIs. Ratios and means are rounded where a sum of doubles may come in any order.


def _kpi(name: str, grain: str = "patient", rounded: str | None = None) -> Query:
    def run(spark, sf_dir):
        result = kpis.KPIS[name](star(spark, sf_dir, grain))
        return result if rounded is None else result.withColumn(rounded, F.round(rounded, 6))

    return run


for _name in kpis.KPIS:
    _mean = "avg_treatment_duration" if _name == "avg_treatment_duration" else None
    QUERIES[_name] = _kpi(_name, rounded=_mean)
    QUERIES[f"{_name}_visits"] = _kpi(_name, "visit", _mean)


@query
def bed_occupancy_dept_female(spark, sf_dir):
    """A KPI sliced by gender."""
    return kpis.bed_occupancy_dept(star(spark, sf_dir), gender="Female")


@query
def view_department_inflow(spark, sf_dir):
    """The KPI as SQL text over the three named tables."""
    views.register_star(star(spark, sf_dir))
    tables = {t: t for t in ("fact_patient_flow", "dim_patient", "dim_department")}
    return spark.sql(views.view_sql("department_inflow", tables))


def _bucketed(kpi: str) -> Query:
    def run(spark, sf_dir):
        place = scratch_dir(spark, "bucketed")
        database = f"wardstream_{place.rsplit('-', 1)[1]}"
        spark.sql(f"CREATE DATABASE {database} LOCATION '{place}'")
        publish_bucketed(star(spark, sf_dir, "visit"), database, buckets=16)
        return kpis.KPIS[kpi](catalogue_star(spark, database, "visit"))

    return run


for _name in ("patient_demographics", "department_inflow"):
    QUERIES[f"{_name}_bucketed"] = _bucketed(_name)


# Streams. Each run has its own folder and checkpoint, and returns the table it wrote.


def _drain(query) -> None:
    query.awaitTermination()


def _bronze(spark, sf_dir, root, faults=True) -> DataFrame:
    wire = src.wire(src.events_stream(spark, sf_dir), faults)
    _drain(ingest.start_bronze(wire, f"{root}/bronze", f"{root}/cp1", AS_OF, available_now=True))
    return spark.read.schema(schemas.BRONZE).parquet(f"{root}/bronze")


def _silver(spark, sf_dir, root, faults=True) -> DataFrame:
    _bronze(spark, sf_dir, root, faults)
    bronze = table_stream(spark, f"{root}/bronze", schemas.BRONZE)
    _drain(ingest.start_silver(bronze, f"{root}/silver", f"{root}/cp2", AS_OF, available_now=True))
    return spark.read.schema(schemas.SILVER).parquet(f"{root}/silver")


@query
def stream_bronze(spark, sf_dir):
    return _bronze(spark, sf_dir, scratch_dir(spark, "stream"))


@query
def stream_silver(spark, sf_dir):
    return _silver(spark, sf_dir, scratch_dir(spark, "stream"))


@query
def stream_gold(spark, sf_dir):
    """Bronze, silver and gold streams in a row, gold in several batches; the fact they end in."""
    root = scratch_dir(spark, "stream")
    silver = _silver(spark, sf_dir, root, faults=False)
    rows = _delivered(spark, silver, root)
    gold = Gold(spark, f"{root}/gold", dense_keys=False)
    _drain(gold_stream.start_gold(rows, gold, f"{root}/cp3", AS_OF, available_now=True))
    return gold.fact.read()


@query
def stream_gold_parts(spark, sf_dir):
    """The fact after a gold stream by parts, in several batches."""
    root = scratch_dir(spark, "stream")
    gold = PartedGold(spark, f"{root}/gold", parts=16)
    rows = _delivered(spark, silver_rows(spark, sf_dir), root)
    _drain(gold_stream.start_gold(rows, gold, f"{root}/cp", AS_OF, available_now=True))
    return gold.fact()


@query
def gold_refresh_parts(spark, sf_dir):
    """The patient versions after two refreshes by parts."""
    gold = PartedGold(spark, scratch_dir(spark, "gold-parts"), parts=16)
    rows = silver_rows(spark, sf_dir)
    cut = F.lit(FIRST_LOAD).cast("timestamp_ntz")
    gold.refresh(rows.filter(F.col("admission_time") < cut), FIRST_LOAD)
    gold.refresh(rows.filter(F.col("admission_time") >= cut), AS_OF)
    return gold.patients()


@query
def gold_refresh_split(spark, sf_dir):
    """The patient versions after two refreshes by parts that divide as they grow, with exact keys taken in blocks.

    Which key a version gets depends on its part, so what is returned of it is whether no other has it and it was given out.
    """
    gold = PartedGold(spark, scratch_dir(spark, "gold-split"), parts=1, split_rows=64, key_block=16)
    rows = silver_rows(spark, sf_dir)
    cut = F.lit(FIRST_LOAD).cast("timestamp_ntz")
    gold.refresh(rows.filter(F.col("admission_time") < cut), FIRST_LOAD)
    gold.refresh(rows.filter(F.col("admission_time") >= cut), AS_OF)
    given = F.col("surrogate_key").between(1, gold.state().free_key - 1)
    alone = F.count(F.lit(1)).over(Window.partitionBy("surrogate_key")) == 1
    return gold.patients().withColumn("exact_key", given & alone).drop("surrogate_key")


@query
def stream_gold_state(spark, sf_dir):
    """The fact after a gold stream by parts whose state holds the latest encounters, in several batches."""
    root = scratch_dir(spark, "stream")
    gold = PartedGold(spark, f"{root}/gold", parts=1, split_rows=64, keeps_latest=False)
    rows = _delivered(spark, silver_rows(spark, sf_dir), root)
    _drain(gold_stream.start_gold(rows, gold, f"{root}/cp", AS_OF, available_now=True))
    return gold.fact()


#: Files of a delivery; each is a micro-batch of its own.
DELIVERIES = 6


def _delivered(spark, rows: DataFrame, root: str) -> DataFrame:
    """``rows`` as a stream of several micro-batches, in no order of admission."""
    shuffled = rows.repartition(DELIVERIES, F.xxhash64("event_id", "arrived_at"))
    shuffled.write.parquet(f"{root}/in")
    return table_stream(spark, f"{root}/in", schemas.SILVER, max_files_per_trigger=1)


@query
def stream_trend(spark, sf_dir):
    """Windows closed by the end of the input, which comes in several batches in no order of time."""
    root = scratch_dir(spark, "stream")
    rows = _delivered(spark, usable(spark, sf_dir), root)
    _drain(trend.start_trend(rows, f"{root}/out", f"{root}/cp", available_now=True))
    return trend.read_trend(spark, f"{root}/out", delay="1 hour")


@query
def stream_trend_patients(spark, sf_dir):
    """Closed windows with the number of distinct patients, from the sketches of several batches, added up in tiers."""
    root = scratch_dir(spark, "stream")
    rows = _delivered(spark, usable(spark, sf_dir), root)
    _drain(trend.start_trend(rows, f"{root}/out", f"{root}/cp", available_now=True, tier=2))
    return trend.read_trend(spark, f"{root}/out", delay="1 hour", patients=True)


@query
def stream_dedup(spark, sf_dir):
    """Every event delivered twice within an hour, in several batches, and kept once."""
    root = scratch_dir(spark, "stream")
    rows = usable(spark, sf_dir)
    copies = [
        rows.withColumn(
            "arrived_at",
            F.lit(AS_OF).cast("timestamp_ntz")
            + F.make_dt_interval(secs=(F.col("event_id") % 1000 + late).cast("decimal(18,6)")),
        )
        for late in (0, 1200)
    ]
    delivered = _delivered(spark, copies[0].unionByName(copies[1]), root)
    once = trend.dedup_events(delivered, "1 hour")
    _drain(ingest.append_stream(once, f"{root}/out", f"{root}/cp", available_now=True))
    # Which of the two deliveries is kept depends on their order.
    return spark.read.schema(schemas.SILVER).parquet(f"{root}/out").drop("arrived_at")


@query
def stream_once(spark, sf_dir):
    """Every event delivered twice, thirty days apart, in several batches, and kept once."""
    root = scratch_dir(spark, "stream")
    rows = usable(spark, sf_dir)
    copies = [
        rows.withColumn("arrived_at", F.lit(AS_OF).cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(days)))
        for days in (0, 30)
    ]
    delivered = _delivered(spark, copies[0].unionByName(copies[1]), root)
    _drain(once.start_once(delivered, f"{root}/out", f"{root}/cp", available_now=True))
    # Which of the two deliveries is kept depends on their order.
    return once.read_once(spark, f"{root}/out", schemas.SILVER).drop("arrived_at")


@query
def stream_quality(spark, sf_dir):
    """Rule violations, added up from the counts that a silver stream left for each of its batches."""
    root = scratch_dir(spark, "stream")
    bronze = _bronze(spark, sf_dir, root)
    split = bronze.repartition(DELIVERIES, F.xxhash64("event_id", "raw_json"))
    split.write.parquet(f"{root}/in")
    rows = table_stream(spark, f"{root}/in", schemas.BRONZE, max_files_per_trigger=1)
    log = quality.QualityLog(spark, f"{root}/quality", "dq")
    with log:
        silver = ingest.start_silver(rows, f"{root}/silver", f"{root}/cp", AS_OF, dq="dq", available_now=True)
        _drain(silver)
        log.wait(silver)
    return quality.profile(spark, f"{root}/quality").filter("rule <> 'wrong_type'")
