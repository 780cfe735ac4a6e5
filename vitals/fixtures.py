"""Health-shaped views over the generated test tables.

Each view has a Spark form and a DuckDB SQL form built from the same formulas.
Every row of the table takes part; remainders of ids only spread metrics and
source names over the rows.
"""

import posixpath
import sys
import zipfile
import zlib
from contextlib import ExitStack
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .schema import RECORD_SCHEMA, RECORD_TYPES, WORKOUT_SCHEMA
from .sources.archives import open_fs

SOURCES = ("Wrist Watch", "Zepp", "Phone")
INGESTED = "2024-06-01 00:00:00"
REINGESTED = "2024-06-02 00:00:00"
SECONDS_PER_UNIT = 600

MOVEMENT = {
    "click": "step_count", "view": "active_energy", "purchase": "basal_energy",
    "signup": "distance", "error": "flights_climbed",
}
PULSE = dict.fromkeys(MOVEMENT, "heart_rate")
CARDIO = {
    "click": "resting_heart_rate", "view": "hrv", "purchase": "vo2_max",
    "signup": "blood_oxygen", "error": "blood_oxygen",
}
BREATH = {
    "click": "respiratory_rate", "view": "respiratory_rate", "purchase": "respiratory_rate",
    "signup": "breathing_disturbances", "error": "breathing_disturbances",
}
SLEEP = dict.fromkeys(MOVEMENT, "sleep")
STAGES = {
    "click": "AsleepDeep", "view": "AsleepCore", "purchase": "AsleepREM",
    "signup": "Awake", "error": "InBed",
}
STAGE_CODES = {"click": 2.0, "view": 3.0, "purchase": 4.0, "signup": 5.0, "error": 0.0}
BODY = (
    "body_mass", "flights_climbed", "time_in_daylight", "walking_speed",
    "wrist_temperature", "exercise_time", "stand_hour", "physical_effort",
)


def case_sql(column: str, values: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in values.items())
    return f"CASE {column} {arms} END"


def pick_sql(number: str, values: tuple) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {number} % {len(values)} {arms} END"


@dataclass(frozen=True)
class RecordView:
    """``records`` made from ``events``: SQL for the metric and value an event gets."""

    metric: str
    value: str

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        return events.selectExpr(
            "event_id AS row_id",
            "event_type",
            "CAST(user_id AS STRING) AS user_id",
            f"{pick_sql('event_id', SOURCES)} AS source_name",
            "'1' AS source_version",
            "'' AS device",
            "'count' AS unit",
            "ts AS creation_date",
            "ts AS start_date",
            f"ts + make_dt_interval(0, 0, 0, CAST(floor(value) * {SECONDS_PER_UNIT} AS DECIMAL(18, 6))) AS end_date",
            f"CAST({self.value} AS DOUBLE) AS value",
            f"{self.metric} AS type",
            f"TIMESTAMP_NTZ '{INGESTED}' AS ingested_at",
            "'events' AS file_source",
            "CAST(ts AS DATE) AS date",
        )

    def sql(self) -> str:
        return f"""SELECT event_id AS row_id, CAST(user_id AS VARCHAR) AS user_id,
            {pick_sql('event_id', SOURCES)} AS source_name, '1' AS source_version, '' AS device,
            'count' AS unit, ts AS creation_date, ts AS start_date,
            ts + to_seconds(CAST(floor(value) * {SECONDS_PER_UNIT} AS BIGINT)) AS end_date,
            CAST({self.value} AS DOUBLE) AS value, {self.metric} AS type,
            TIMESTAMP '{INGESTED}' AS ingested_at, 'events' AS file_source, CAST(ts AS DATE) AS date
            FROM events"""


def by_event_type(metrics: dict, whole: bool = False) -> RecordView:
    """One metric per event type; ``whole`` cuts values to whole numbers, whose
    sums do not depend on the order of adding."""
    return RecordView(case_sql("event_type", metrics), "floor(value)" if whole else "value")


def movement(whole=False):
    return by_event_type(MOVEMENT, whole)


def sleep_view() -> RecordView:
    return RecordView("'sleep'", case_sql("event_type", STAGE_CODES))


def body_view() -> RecordView:
    """Eight metrics in turn; stand hours have values 0 and 1."""
    metric = pick_sql("event_id", BODY)
    return RecordView(metric, f"CASE WHEN {metric} = 'stand_hour' THEN floor(value) % 2 ELSE value END")


def all_metrics() -> RecordView:
    """Every metric in turn. Whole values, small enough to be sleep stages too."""
    return RecordView(pick_sql("event_id", tuple(RECORD_TYPES.values())), "floor(value) % 6")


def records(frame: DataFrame) -> DataFrame:
    """The view's rows with exactly the silver columns."""
    return frame.to(RECORD_SCHEMA)


def workouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``workouts`` made from ``orders``."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.selectExpr(
        "CAST(o_custkey AS STRING) AS user_id",
        "o_orderpriority AS workout_type",
        "CAST(floor(o_totalprice / 1000) AS DOUBLE) AS duration",
        "'min' AS duration_unit",
        "CAST(o_orderkey % 20 AS DOUBLE) AS total_distance",
        "'km' AS total_distance_unit",
        "o_totalprice AS total_energy_burned",
        "'kcal' AS total_energy_burned_unit",
        f"{pick_sql('o_orderkey', SOURCES)} AS source_name",
        "'1' AS source_version",
        "o_orderdate AS start_date",
        "o_orderdate + make_dt_interval(0, 0, CAST(floor(o_totalprice / 1000) AS INT)) AS end_date",
        f"TIMESTAMP_NTZ '{INGESTED}' AS ingested_at",
        "'orders' AS file_source",
        "CAST(o_orderdate AS DATE) AS date",
    ).to(WORKOUT_SCHEMA)


WORKOUTS_SQL = f"""SELECT CAST(o_custkey AS VARCHAR) AS user_id, o_orderpriority AS workout_type,
    CAST(floor(o_totalprice / 1000) AS DOUBLE) AS duration, 'min' AS duration_unit,
    CAST(o_orderkey % 20 AS DOUBLE) AS total_distance, 'km' AS total_distance_unit,
    o_totalprice AS total_energy_burned, 'kcal' AS total_energy_burned_unit,
    {pick_sql('o_orderkey', SOURCES)} AS source_name, '1' AS source_version,
    o_orderdate AS start_date,
    o_orderdate + to_minutes(CAST(floor(o_totalprice / 1000) AS BIGINT)) AS end_date,
    TIMESTAMP '{INGESTED}' AS ingested_at, 'orders' AS file_source, CAST(o_orderdate AS DATE) AS date
    FROM orders"""


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered users: customers with money on their account."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customers.where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").cast("string").alias("username"),
        F.lit(INGESTED).cast("timestamp_ntz").alias("created_at"),
    )


USERS_SQL = f"""SELECT CAST(c_custkey AS VARCHAR) AS username, TIMESTAMP '{INGESTED}' AS created_at
    FROM customer WHERE c_acctbal > 0"""


# ---------------------------------------------------------------- export XML

_VENDOR = {short: vendor for vendor, short in RECORD_TYPES.items()}


def _clock(column: str) -> Column:
    """Wall-clock attribute text with an offset that is to be ignored."""
    return F.concat(F.date_format(column, "yyyy-MM-dd HH:mm:ss"), F.lit(" -0300"))


def _element(tag: str, children: Column | None = None, **attributes: Column) -> Column:
    parts = [F.lit(f"<{tag}")]
    for name, value in attributes.items():
        parts += [F.lit(f' {name}="'), value.cast("string"), F.lit('"')]
    parts += [F.lit("/>")] if children is None else [F.lit(">"), children, F.lit(f"</{tag}>")]
    return F.concat(*parts)


def record_xml(
    spark: SparkSession, sf_dir: str, metrics: dict = MOVEMENT, texts: dict | None = None, start: Column | None = None, end: Column | None = None,
) -> DataFrame:
    """(user_id, event_id, xml): one ``Record`` element per event.

    Values are the events' numbers, or ``texts`` by event type; ``start`` and
    ``end`` are other texts for the dates. The test table
    is one file, so its rows are spread for the parsing that follows.
    """
    value = F.col("value") if texts is None else F.expr(case_sql("event_type", texts))
    return _vendor_view(metrics).frame(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism).select(
        "user_id", F.col("row_id").alias("event_id"), _record_element(value, start, end).alias("xml"))


def _vendor_view(metrics: dict) -> RecordView:
    return by_event_type({event: _VENDOR[metric] for event, metric in metrics.items()})


def _record_element(value: Column, start: Column | None = None, end: Column | None = None) -> Column:
    return _element(
        "Record", type=F.col("type"), sourceName=F.col("source_name"), sourceVersion=F.lit("1"),
        unit=F.col("unit"), creationDate=_clock("creation_date"), startDate=_clock("start_date") if start is None else start,
        endDate=_clock("end_date") if end is None else end, value=value,
    )


def workout_xml(spark: SparkSession, sf_dir: str, duration: Column | None = None) -> DataFrame:
    """(user_id, workout_id, xml): one ``Workout`` with two statistics per order; ``duration`` is another text for it."""
    orders = _orders(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism)
    return orders.select("user_id", F.col("o_orderkey").alias("workout_id"), _workout_element(duration).alias("xml"))


def _minutes() -> Column:
    return F.floor(F.col("o_totalprice") / 1000)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    ends = F.col("o_orderdate") + F.make_dt_interval(mins=_minutes().cast("int"))
    return orders.select(
        F.col("o_custkey").cast("string").alias("user_id"), "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate", ends.alias("_end"))


def _workout_element(duration: Column | None = None) -> Column:
    statistics = F.concat(
        _element("WorkoutStatistics", type=F.lit("HKQuantityTypeIdentifierActiveEnergyBurned"),
                 sum=F.col("o_totalprice"), unit=F.lit("kcal")),
        _element("WorkoutStatistics", type=F.lit("HKQuantityTypeIdentifierDistanceWalkingRunning"),
                 sum=F.col("o_orderkey") % 20, unit=F.lit("km")),
    )
    return _element(
        "Workout", children=statistics, workoutActivityType=F.col("o_orderpriority"),
        duration=_minutes() if duration is None else duration, durationUnit=F.lit("min"), totalDistance=F.lit("-1"),
        sourceName=F.expr(pick_sql("o_orderkey", SOURCES)), sourceVersion=F.lit("1"),
        startDate=_clock("o_orderdate"), endDate=_clock("_end"),
    )


USER_IN_NAME = r"([^/]+)\.zip$"


def write_archives(spark: SparkSession, sf_dir: str, folder: str, metrics: dict = MOVEMENT) -> None:
    """One export archive per user, ``<user>.zip`` in one of 256 folders below ``folder``, streamed batch by batch.

    The tables' columns are shuffled, not the longer elements made of them.
    """
    records = _vendor_view(metrics).frame(spark, sf_dir).select(
        "user_id", F.lit(0).alias("kind"), F.col("row_id").alias("id"),
        "type", "source_name", "unit", "creation_date", "start_date", "end_date", "value")
    workouts = _orders(spark, sf_dir).withColumns({"kind": F.lit(1), "id": F.col("o_orderkey")})
    rows = records.unionByName(workouts, allowMissingColumns=True)
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (
        rows.repartition(tasks, "user_id").sortWithinPartitions("user_id", "kind", "id")
        .select("user_id", F.when(F.col("kind") == 0, _record_element(F.col("value"))).otherwise(_workout_element()).alias("xml"))
        .mapInArrow(_archive_writer(folder), "user_id string")
        .write.format("noop").mode("overwrite").save()
    )


def _archive_writer(folder: str):
    def run(batches):
        user = None
        with ExitStack() as open_files:
            for batch in batches:
                runs, elements, begin = pc.run_end_encode(batch.column(0)), batch.column(1).to_pylist(), 0
                for end, name in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
                    if name != user:
                        open_files.close()
                        user = name
                        below = f"{zlib.crc32(user.encode()) % 256:02x}"
                        member = _open_export(open_files, posixpath.join(folder, below, f"{user}.zip"))
                    member.write("\n".join([*elements[begin:end], ""]).encode())
                    begin = end
                yield pa.RecordBatch.from_arrays([runs.values], ["user_id"])

    return run


def _open_export(open_files: ExitStack, path: str):
    """An export inside a new archive; closing ``open_files`` completes both."""
    fs, target = open_fs(path)
    fs.create_dir(posixpath.dirname(target), recursive=True)
    stream = open_files.enter_context(fs.open_output_stream(target))
    archive = open_files.enter_context(zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED))
    export = zipfile.ZipInfo("data/export.xml")
    export.compress_type = zipfile.ZIP_DEFLATED  # an entry of its own does not take the archive's
    member = open_files.enter_context(archive.open(export, "w"))
    member.write(b'<?xml version="1.0" encoding="UTF-8"?>\n<HealthData>\n')
    open_files.callback(member.write, b"</HealthData>")
    return member


cloudpickle.register_pickle_by_value(sys.modules[__name__])
