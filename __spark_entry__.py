"""

Every query runs over whole tables, shaped as health data by
``vitals.fixtures``. Results are shown with days and times as text and
fractions rounded, so that both engines print the same values.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import inheritable_thread_target  # noqa: E402
from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from vitals import fixtures as fx  # noqa: E402
from vitals.operators import (  # noqa: E402
    Measure, daily_states, full_outer_by_key, insert_if_absent, keep_first, latest_per_user, merged_states, require_known_users,
    state_rollup, suppress_overlaps, top_n, upsert_by_key,
)
from vitals.plans import explore, gold, pipeline, serve  # noqa: E402
from vitals.schema import RECORD_KEYS  # noqa: E402
from vitals.session import shared_folder  # noqa: E402
from vitals.sources import archives, export_xml, tables  # noqa: E402
from vitals.streaming import ingest_archives  # noqa: E402

try:  # these two folders may be taken out; everything else works without them
    import corpus_pipeline  # noqa: E402
    from vitals.llm import queries as training_data  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "vitals.llm"):
        raise
    corpus_pipeline = training_data = None

TEST_DATA = "/root/testdata/sf0.001"


def later():
    return F.lit(fx.REINGESTED).cast("timestamp_ntz")



def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Days and times as text, fractions rounded."""
    def plain(field):
        kind, column = field.dataType.typeName(), F.col(field.name)
        if kind == "date":
            return column.cast("string")
        if kind == "timestamp_ntz":
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return F.round(column, digits) if kind == "double" else column

    return df.select(*[plain(f).alias(f.name) for f in df.schema.fields])


def day(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS VARCHAR) AS {name or column}"


def clock(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name or column}"


def rounded(expression: str, name: str | None = None, digits: int = 6) -> str:
    return f"round({expression}, {digits}) AS {name or expression}"


def work_folder(spark: SparkSession) -> str:
    """A new folder on the cluster's shared storage, or a local one in tests."""
    shared = shared_folder(spark)
    if shared:
        return f"{shared.rstrip('/')}/vitals-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="vitals-")


# ------------------------------------------------------------ shared inputs


def movement(spark, sf, whole=False):
    return fx.movement(whole).frame(spark, sf)


def gold_activity(spark, sf):
    return gold.daily_activity(movement(spark, sf, whole=True))


def gold_sleep(spark, sf):
    return gold.daily_sleep(fx.sleep_view().frame(spark, sf))


def gold_cardio(spark, sf):
    return gold.daily_cardiovascular(fx.by_event_type(fx.CARDIO, whole=True).frame(spark, sf))


def gold_breath(spark, sf):
    return gold.daily_respiratory(fx.by_event_type(fx.BREATH).frame(spark, sf))


def gold_workouts(spark, sf):
    return gold.workouts_summary(fx.workouts(spark, sf))


# SQL of the same inputs, as common table expressions.

def ranked(alias: str) -> str:
    """Rank of a source: its place among the fixture's sources, best first."""
    return f"list_position({list(fx.SOURCES)!r}, {alias}.source_name)"


SURVIVES = f"""NOT EXISTS (
    FROM records better
    WHERE better.user_id = p1.user_id AND better.type = p1.type AND {ranked('better')} < {ranked('p1')}
      AND better.end_date > p1.start_date AND better.start_date < p1.end_date)"""


def with_records(view: fx.RecordView, body: str) -> str:
    return f"WITH records AS ({view.sql()})\n{body}"


def daily_total(metric: str, name: str) -> str:
    return f"""SELECT user_id, date, SUM(value) AS {name} FROM records p1
        WHERE type = '{metric}' AND {SURVIVES} GROUP BY user_id, date"""


ACTIVITY_BODY = f"""SELECT user_id, date,
    coalesce(step_count, 0.0) AS step_count, coalesce(active_energy_kcal, 0.0) AS active_energy_kcal,
    coalesce(basal_energy_kcal, 0.0) AS basal_energy_kcal, coalesce(distance_km, 0.0) AS distance_km
    FROM ({daily_total('step_count', 'step_count')}) s
    FULL OUTER JOIN ({daily_total('active_energy', 'active_energy_kcal')}) a USING (user_id, date)
    FULL OUTER JOIN ({daily_total('basal_energy', 'basal_energy_kcal')}) b USING (user_id, date)
    FULL OUTER JOIN ({daily_total('distance', 'distance_km')}) d USING (user_id, date)"""


def stage_minutes(code: float) -> str:
    return f"coalesce(SUM(date_diff('second', start_date, end_date) / 60) FILTER (WHERE value = {code}), 0)"


SLEEP_BODY = f"""SELECT user_id, date,
    {stage_minutes(1.0)} + {stage_minutes(2.0)} + {stage_minutes(3.0)} + {stage_minutes(4.0)} AS total_sleep_minutes,
    {stage_minutes(1.0)} AS asleep_minutes, {stage_minutes(2.0)} AS deep_sleep_minutes,
    {stage_minutes(3.0)} AS light_sleep_minutes, {stage_minutes(4.0)} AS rem_sleep_minutes,
    {stage_minutes(5.0)} AS awake_minutes
    FROM records WHERE type = 'sleep' GROUP BY user_id, date"""


def daily_figures(metric: str, *figures: str) -> str:
    return f"SELECT user_id, date, {', '.join(figures)} FROM records WHERE type = '{metric}' GROUP BY user_id, date"


CARDIO_BODY = f"""SELECT user_id, date, avg_resting_heart_rate, avg_hrv_sdnn, avg_vo2_max,
    avg_blood_oxygen, min_blood_oxygen
    FROM ({daily_figures('resting_heart_rate', 'AVG(value) AS avg_resting_heart_rate')}) r
    FULL OUTER JOIN ({daily_figures('hrv', 'AVG(value) AS avg_hrv_sdnn')}) h USING (user_id, date)
    FULL OUTER JOIN ({daily_figures('vo2_max', 'AVG(value) AS avg_vo2_max')}) v USING (user_id, date)
    FULL OUTER JOIN ({daily_figures('blood_oxygen', 'AVG(value) AS avg_blood_oxygen', 'MIN(value) AS min_blood_oxygen')}) o
    USING (user_id, date)"""

BREATH_BODY = f"""SELECT user_id, date, avg_respiratory_rate, min_respiratory_rate, max_respiratory_rate,
    avg_breathing_disturbances
    FROM ({daily_figures('respiratory_rate', 'AVG(value) AS avg_respiratory_rate',
                         'MIN(value) AS min_respiratory_rate', 'MAX(value) AS max_respiratory_rate')}) r
    FULL OUTER JOIN ({daily_figures('breathing_disturbances', 'AVG(value) AS avg_breathing_disturbances')}) d
    USING (user_id, date)"""

METRICS_BODY = f"""SELECT user_id, date, body_mass_kg, flights_climbed, time_in_daylight_minutes,
    avg_walking_speed_kmh, avg_wrist_temperature_c, exercise_time_minutes,
    coalesce(stand_hours, 0) AS stand_hours, avg_physical_effort
    FROM ({daily_figures('body_mass', 'AVG(value) AS body_mass_kg')}) bm
    FULL OUTER JOIN ({daily_total('flights_climbed', 'flights_climbed')}) fc USING (user_id, date)
    FULL OUTER JOIN ({daily_figures('time_in_daylight', 'SUM(value) AS time_in_daylight_minutes')}) dl USING (user_id, date)
    FULL OUTER JOIN ({daily_figures('walking_speed', 'AVG(value) AS avg_walking_speed_kmh')}) ws USING (user_id, date)
    FULL OUTER JOIN ({daily_figures('wrist_temperature', 'AVG(value) AS avg_wrist_temperature_c')}) wt USING (user_id, date)
    FULL OUTER JOIN ({daily_figures('exercise_time', 'SUM(value) AS exercise_time_minutes')}) et USING (user_id, date)
    FULL OUTER JOIN (SELECT user_id, date, COUNT(DISTINCT start_date) AS stand_hours FROM records
        WHERE type = 'stand_hour' AND value = 0.0 GROUP BY user_id, date) sh USING (user_id, date)
    FULL OUTER JOIN ({daily_figures('physical_effort', 'AVG(value) AS avg_physical_effort')}) pe USING (user_id, date)"""

HEART_RATE_BODY = daily_figures(
    "heart_rate", "AVG(value) AS avg_heart_rate", "MIN(value) AS min_heart_rate",
    "MAX(value) AS max_heart_rate", "COUNT(value) AS records_count",
)

WORKOUTS_BODY = f"""SELECT user_id, workout_type, start_date, end_date, duration AS duration_minutes,
    total_energy_burned AS total_energy_kcal, total_distance AS total_distance_km
    FROM ({fx.WORKOUTS_SQL})
    QUALIFY row_number() OVER (PARTITION BY user_id, workout_type, start_date
        ORDER BY ingested_at, source_name, end_date, duration, total_energy_burned, total_distance) = 1"""


def table_sql(view: fx.RecordView | None, body: str) -> str:
    return f"({with_records(view, body) if view else body})"


ACTIVITY = table_sql(fx.movement(whole=True), ACTIVITY_BODY)
SLEEP = table_sql(fx.sleep_view(), SLEEP_BODY)
CARDIO = table_sql(fx.by_event_type(fx.CARDIO, whole=True), CARDIO_BODY)
BREATH = table_sql(fx.by_event_type(fx.BREATH), BREATH_BODY)
WORKOUTS = table_sql(None, WORKOUTS_BODY)


def select_sql(table: str, *columns: str, tail: str = "") -> str:
    return f"SELECT {', '.join(columns)} FROM {table} g {tail}"


def newest(table: str, n: int, order: str = "date DESC") -> str:
    return f"(SELECT * FROM {table} q QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {order}) <= {n})"


def typed_rows(body_columns: list[str], digits: int = 6) -> list[str]:
    """Show list of a gold table: user, date, then rounded figures."""
    return ["user_id", day("date"), *[rounded(c, digits=digits) for c in body_columns]]


# ------------------------------------------------------------ operators


def q_suppress_overlaps(spark, sf):
    kept = suppress_overlaps(movement(spark, sf))
    return shown(kept.select("row_id", "user_id", "type", "source_name", "start_date", "end_date", "value"))


def q_full_outer_by_key(spark, sf):
    rows = movement(spark, sf)

    def total(metric, name):
        return rows.where(F.col("type") == metric).groupBy("user_id", "date").agg(F.sum("value").alias(name))

    frames = [
        total("step_count", "steps"), total("distance", "km"), total("flights_climbed", "flights"),
        total("active_energy", "active_kcal"), total("basal_energy", "basal_kcal"),
    ]
    return shown(full_outer_by_key(frames, ("user_id", "date")))


def later_records(rows):
    """The same export a day later, with all distances corrected."""
    return rows.withColumn("ingested_at", later()).withColumn(
        "value", F.when(F.col("type") == "distance", F.col("value") + 1).otherwise(F.col("value"))
    )


LATER_SQL = f"""SELECT * REPLACE (TIMESTAMP '{fx.REINGESTED}' AS ingested_at,
    CASE WHEN type = 'distance' THEN value + 1 ELSE value END AS value) FROM records"""

DEDUP_BODY = f"""SELECT user_id, type, source_name, {clock('start_date')}, {clock('end_date')}, {rounded('value')},
    {clock('ingested_at')}
    FROM (SELECT * FROM records UNION ALL {LATER_SQL})
    QUALIFY row_number() OVER (PARTITION BY user_id, type, source_name, start_date, end_date, value
        ORDER BY ingested_at) = 1"""

DEDUP_COLUMNS = ("user_id", "type", "source_name", "start_date", "end_date", "value", "ingested_at")


def q_dedup_keep_first(spark, sf):
    rows = fx.records(movement(spark, sf))
    both = rows.unionByName(later_records(rows))
    return shown(keep_first(both, RECORD_KEYS, ("ingested_at",)).select(*DEDUP_COLUMNS))


def q_merge_into_silver(spark, sf):
    rows = fx.records(movement(spark, sf))
    path = f"{work_folder(spark)}/records"
    tables.merge_records(spark, rows, path, buckets=8)
    tables.merge_records(spark, later_records(rows), path, buckets=8)
    return shown(tables.read_silver(spark, path).select(*DEDUP_COLUMNS))


def q_merge_new_keys(spark, sf):
    """With filters of stored keys: the watch's readings, the other devices', then the whole export of a day later."""
    rows = fx.records(movement(spark, sf))
    path = f"{work_folder(spark)}/records"
    watch = F.col("source_name").like("%Watch%")
    tables.merge_records(spark, rows.where(watch), path, buckets=8, filtered=True)
    tables.merge_records(spark, rows.where(~watch | watch.isNull()), path, buckets=8)
    tables.merge_records(spark, later_records(rows), path, buckets=8)
    return shown(tables.read_silver(spark, path).select(*DEDUP_COLUMNS))


def q_merge_backdated(spark, sf):
    """The older export arrives second: touched partitions are replaced."""
    rows = fx.records(movement(spark, sf))
    path = f"{work_folder(spark)}/records"
    tables.merge_records(spark, later_records(rows), path, buckets=8)
    tables.merge_records(spark, rows, path, buckets=8)
    return shown(tables.read_silver(spark, path).select(*DEDUP_COLUMNS))


def q_read_silver(spark, sf):
    """Pruned read of two metrics for registered users."""
    path = f"{work_folder(spark)}/records"
    tables.merge_records(spark, fx.records(movement(spark, sf)), path, buckets=8)
    known = fx.users(spark, sf).select(F.col("username").alias("user_id"))
    rows = tables.read_silver(spark, path, types=["step_count", "distance"], users=known)
    return shown(rows.select("user_id", "type", "source_name", "start_date", "end_date", "value"))


def heart_by_day(rows):
    return gold.daily_heart_rate(rows)


def upsert_inputs(spark, sf):
    """A full daily table, and newer figures from whole-number readings of watch days."""
    existing = heart_by_day(fx.by_event_type(fx.PULSE).frame(spark, sf))
    watch = fx.by_event_type(fx.PULSE, whole=True).frame(spark, sf).where(F.col("source_name").like("%Watch%"))
    return existing, heart_by_day(watch)


HEART_SHOWN = typed_rows(["avg_heart_rate", "min_heart_rate", "max_heart_rate"]) + ["records_count"]
UPSERT_SQL = f"""WITH existing AS (SELECT * FROM {table_sql(fx.by_event_type(fx.PULSE), HEART_RATE_BODY)}),
    incoming AS (SELECT * FROM {table_sql(
        fx.by_event_type(fx.PULSE, whole=True),
        HEART_RATE_BODY.replace("type = 'heart_rate'", "type = 'heart_rate' AND source_name LIKE '%Watch%'"))})
    SELECT {', '.join(HEART_SHOWN)}, '{fx.INGESTED}' AS updated_at FROM existing e
        WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.user_id = e.user_id AND i.date = e.date)
    UNION ALL SELECT {', '.join(HEART_SHOWN)}, '{fx.REINGESTED}' AS updated_at FROM incoming"""


def stamped(df):
    return shown(df.withColumn("updated_at", F.col("updated_at").cast("string")))


def q_upsert_by_key(spark, sf):
    existing, incoming = upsert_inputs(spark, sf)
    existing = existing.withColumn("updated_at", F.lit(fx.INGESTED).cast("timestamp_ntz"))
    return stamped(upsert_by_key(existing, incoming, ("user_id", "date"), later()))


def q_upsert_gold(spark, sf):
    existing, incoming = upsert_inputs(spark, sf)
    root, table = work_folder(spark), "daily_heart_rate_summary"
    tables.upsert_gold(spark, existing, root, table, F.lit(fx.INGESTED), buckets=4)
    tables.upsert_gold(spark, incoming, root, table, later(), buckets=4)
    return stamped(tables.read_gold(spark, root, table))


# Every metric, so that each gold table gets rows: (table, body, a figure to add up).
STORED_GOLD = (
    ("daily_heart_rate_summary", HEART_RATE_BODY, "avg_heart_rate"),
    ("daily_activity_summary", ACTIVITY_BODY, "step_count + active_energy_kcal + basal_energy_kcal + distance_km"),
    ("workouts_summary", WORKOUTS_BODY, "duration_minutes"),
    ("daily_sleep_summary", SLEEP_BODY, "awake_minutes"),
    ("daily_cardiovascular_summary", CARDIO_BODY, "coalesce(avg_blood_oxygen, 0) + coalesce(avg_hrv_sdnn, 0)"),
    ("daily_respiratory_summary", BREATH_BODY, "coalesce(max_respiratory_rate, 0)"),
    ("daily_metrics_summary", METRICS_BODY, "stand_hours + coalesce(flights_climbed, 0)"),
)
STORED_GOLD_SQL = with_records(fx.all_metrics(), " UNION ALL ".join(
    f"SELECT '{table}' AS name, COUNT(*) AS stored, round(SUM({figure}), 3) AS total FROM ({body}) b"
    for table, body, figure in STORED_GOLD
))


def q_store_all_gold(spark, sf):
    """All seven tables built and upserted, the second time over themselves."""
    lake = pipeline.Lake(work_folder(spark), record_buckets=2, gold_buckets=2)
    tables.merge_records(spark, fx.records(fx.all_metrics().frame(spark, sf)), lake.records, lake.record_buckets)
    tables.merge_workouts(spark, fx.workouts(spark, sf), lake.workouts, lake.record_buckets)
    for stamp in (F.lit(fx.INGESTED), later()):
        pipeline.refresh_gold(spark, lake, stamp)
    sums = [
        tables.read_gold(spark, lake.gold, table).selectExpr(
            f"'{table}' AS name", f"CAST({figure} AS DOUBLE) AS figure")
        for table, _, figure in STORED_GOLD
    ]
    united = reduce(DataFrame.unionByName, sums)
    return united.groupBy("name").agg(F.count("*").alias("stored"), F.round(F.sum("figure"), 3).alias("total"))


def q_gold_two_writers(spark, sf):
    """Two writers beside each other, half the new figures each, and a compaction after."""
    existing, incoming = upsert_inputs(spark, sf)
    root, table = work_folder(spark), "daily_heart_rate_summary"
    tables.upsert_gold(spark, existing, root, table, F.lit(fx.INGESTED), buckets=4)
    half = F.pmod(F.xxhash64("user_id", "date"), F.lit(2))

    def write(part):
        tables.upsert_gold(spark, incoming.where(half == part), root, table, later())

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), (0, 1)))
    tables.compact_gold(spark, root, table)
    return stamped(tables.read_gold(spark, root, table))


def q_empty_batch(spark, sf):
    """A batch without rows changes nothing."""
    existing, incoming = upsert_inputs(spark, sf)
    root, table = work_folder(spark), "daily_heart_rate_summary"
    tables.upsert_gold(spark, existing, root, table, F.lit(fx.INGESTED), buckets=4)
    tables.upsert_gold(spark, incoming.where(F.lit(False)), root, table, later())
    return stamped(tables.read_gold(spark, root, table))


def q_gold_refusals(spark, sf):
    """Rows of unknown users, without a date, of too long names, given twice: what is stored, and why the rest is not."""
    rows, _ = upsert_inputs(spark, sf)
    rows, place = rows.withColumn("place", F.col("user_id").cast("long") % 5), F.col("place")
    rows = rows.withColumn("date", F.when(place != 1, F.col("date"))).withColumn(
        "user_id", F.when(place == 2, F.rpad("user_id", 60, "x")).otherwise(F.col("user_id")))
    rows = rows.unionByName(rows.where(place == 3).withColumn("records_count", F.col("records_count") + 1)).drop("place")
    root, table = work_folder(spark), "daily_heart_rate_summary"
    for _ in range(2):  # repeating the batch adds nothing, there as here
        tables.upsert_gold(spark, rows, f"{root}/gold", table, later(), 4, fx.users(spark, sf), f"{root}/refused")
    stored = tables.read_gold(spark, f"{root}/gold", table).withColumn("refused", F.lit(None).cast("string"))
    refused = spark.read.parquet(f"{root}/refused/{table}")
    return shown(stored.unionByName(refused.select(stored.columns)).drop("updated_at"))


GOLD_REFUSALS_SQL = f"""WITH figures AS (SELECT *, CAST(user_id AS BIGINT) % 5 AS place
        FROM {table_sql(fx.by_event_type(fx.PULSE), HEART_RATE_BODY)} f),
    odd AS (SELECT * REPLACE (CASE WHEN place <> 1 THEN date END AS date,
        CASE WHEN place = 2 THEN rpad(user_id, 60, 'x') ELSE user_id END AS user_id), false AS twice FROM figures
        UNION ALL SELECT * REPLACE (records_count + 1 AS records_count), true FROM figures WHERE place = 3)
    SELECT {', '.join(HEART_SHOWN)}, CASE WHEN date IS NULL THEN 'date is missing'
        WHEN length(user_id) > 50 THEN 'user_id is longer than 50 characters'
        WHEN twice THEN 'the key is there twice'
        WHEN user_id NOT IN (SELECT username FROM ({fx.USERS_SQL})) THEN 'the user is not known' END AS refused FROM odd"""


def in_two_merges(spark, sf, view, lake, refresh):
    """Nine tenths of the view's rows merged first, all of them after; ``refresh`` runs after each."""
    frame = view.frame(spark, sf)
    for rows in (frame.where("row_id % 10 <> 0"), frame):
        tables.merge_records(spark, fx.records(rows), lake.records, lake.record_buckets, feed=lake.record_feed(spark))
        refresh()


def q_changed_days(spark, sf):
    """Activity kept current by the days that merges change."""
    lake = pipeline.Lake(work_folder(spark), record_buckets=4, gold_buckets=2)
    in_two_merges(spark, sf, fx.movement(whole=True), lake, lambda: pipeline.refresh_changed(spark, lake, later()))
    return shown(tables.read_gold(spark, lake.gold, "daily_activity_summary").drop("updated_at"))


ACTIVITY_SHOWN = typed_rows(["step_count", "active_energy_kcal", "basal_energy_kcal", "distance_km"])
# An upsert keeps days that the newer build has no row for.
CHANGED_DAYS_SQL = f"""WITH built AS (SELECT * FROM {ACTIVITY} a), before AS (
        WITH records AS (SELECT * FROM ({fx.movement(whole=True).sql()}) r WHERE row_id % 10 <> 0) {ACTIVITY_BODY})
    SELECT {', '.join(ACTIVITY_SHOWN)} FROM built UNION ALL SELECT {', '.join(ACTIVITY_SHOWN)} FROM before b
    WHERE NOT EXISTS (SELECT 1 FROM built WHERE built.user_id = b.user_id AND built.date = b.date)"""


def q_stored_states(spark, sf):
    """Heart rates from the daily states that two merges left."""
    lake = pipeline.Lake(work_folder(spark), record_buckets=4)
    in_two_merges(spark, sf, fx.by_event_type(fx.PULSE), lake, lambda: None)
    return shown(state_rollup(lake.record_feed(spark).states(), gold.HEART_RATE))


def q_merged_states(spark, sf):
    """States of the rows of each source, merged: averages, sums and distinct starts."""
    rows = fx.body_view().frame(spark, sf)
    states = merged_states(reduce(DataFrame.unionByName, [daily_states(rows.where(F.col("source_name") == s)) for s in fx.SOURCES]))
    return shown(state_rollup(states, [
        Measure("body_mass_kg", "body_mass", "avg"), Measure("time_in_daylight_minutes", "time_in_daylight", "sum"),
        Measure("stand_hours", "stand_hour", "count_distinct", value="start_date", only=F.col("value") == 0.0, default=0, cast="int"),
    ]))


MERGED_STATES_SQL = select_sql(table_sql(fx.body_view(), f"""SELECT user_id, date, body_mass_kg, time_in_daylight_minutes,
    coalesce(stand_hours, 0) AS stand_hours FROM ({daily_figures('body_mass', 'AVG(value) AS body_mass_kg')}) bm
    FULL OUTER JOIN ({daily_figures('time_in_daylight', 'SUM(value) AS time_in_daylight_minutes')}) dl USING (user_id, date)
    FULL OUTER JOIN (SELECT user_id, date, COUNT(DISTINCT start_date) AS stand_hours FROM records
        WHERE type = 'stand_hour' AND value = 0.0 GROUP BY user_id, date) sh USING (user_id, date)"""),
    *typed_rows(["body_mass_kg", "time_in_daylight_minutes"]), "stand_hours")


def q_insert_if_absent(spark, sf):
    seen = movement(spark, sf).select(F.col("user_id").alias("username")).distinct()
    ordering = fx.workouts(spark, sf).select(F.col("user_id").alias("username")).distinct()
    registered = fx.users(spark, sf)
    for newcomers in (seen, ordering):
        registered = insert_if_absent(registered, newcomers.withColumn("created_at", later()), ("username",))
    return shown(registered)


def q_require_known_users(spark, sf):
    daily = gold_workouts(spark, sf)
    known, unknown = require_known_users(daily, fx.users(spark, sf))
    return shown(
        known.withColumn("known", F.lit(True)).unionByName(unknown.withColumn("known", F.lit(False)))
    )


def q_top_n_per_user(spark, sf):
    return shown(top_n(gold_workouts(spark, sf), ("user_id",), 5, [F.desc("start_date"), F.col("workout_type")]))


def q_latest_per_user(spark, sf):
    return shown(latest_per_user(gold_sleep(spark, sf)))


# ------------------------------------------------------------ export XML

RECORD_SHOWN = ("user_id", "type", "source_name", "source_version", "device", "unit", "creation_date",
                "start_date", "end_date", "value", "file_source", "date")


def q_parse_records_xml(spark, sf):
    elements = export_xml.parse_record_elements(fx.record_xml(spark, sf), "xml")
    rows = export_xml.conform_records(elements, later(), F.lit("upload.zip"))
    return shown(export_xml.readable(rows)[0].select(*RECORD_SHOWN))


def q_parse_sleep_xml(spark, sf):
    elements = export_xml.parse_record_elements(fx.record_xml(spark, sf, fx.SLEEP, fx.STAGES), "xml")
    return shown(export_xml.conform_records(elements, later(), F.lit("upload.zip")).select(*RECORD_SHOWN))


def whole_second(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') || '.000000' AS {column}"


def parsed_sql(view: fx.RecordView, file_source: str = "'upload.zip'") -> str:
    return with_records(view, f"""SELECT user_id, type, source_name, source_version, device, unit,
        {whole_second('creation_date')}, {whole_second('start_date')}, {whole_second('end_date')},
        {rounded('value')}, {file_source} AS file_source, {day('date')} FROM records""")


WORKOUT_SHOWN = ("user_id", "workout_type", "duration", "duration_unit", "total_distance", "total_distance_unit",
                 "total_energy_burned", "total_energy_burned_unit", "source_name", "source_version",
                 "start_date", "end_date", "date")
PARSED_WORKOUTS_SQL = f"""SELECT user_id, workout_type, {rounded('duration')}, duration_unit,
    {rounded('total_distance')}, total_distance_unit, {rounded('total_energy_burned')}, total_energy_burned_unit,
    source_name, source_version, {clock('start_date')}, {clock('end_date')}, {day('date')} FROM ({fx.WORKOUTS_SQL}) w"""


def q_parse_workouts_xml(spark, sf):
    elements = export_xml.parse_workout_elements(fx.workout_xml(spark, sf), "xml")
    rows = export_xml.conform_workouts(elements, later(), F.lit("upload.zip"))
    return shown(export_xml.readable(rows)[0].select(*WORKOUT_SHOWN))


def q_quarantined_workouts(spark, sf):
    """Workouts of which every seventh has a duration that is no number."""
    duration = F.when(F.col("o_orderkey") % 7 == 0, "half an hour").otherwise(F.floor(F.col("o_totalprice") / 1000).cast("string"))
    elements = export_xml.parse_workout_elements(fx.workout_xml(spark, sf, duration), "xml")
    good, bad = export_xml.readable(export_xml.conform_workouts(elements, later(), F.lit("upload.zip")))
    columns = ("user_id", "workout_type", "start_date")
    return shown(good.select(*columns, F.lit(True).alias("stored")).unionByName(bad.select(*columns, F.lit(False).alias("stored"))))


QUARANTINED_WORKOUTS_SQL = f"""SELECT user_id, workout_type, {clock('start_date')}, NOT odd AS stored FROM (
    SELECT *, o_orderkey % 7 = 0 AS odd FROM (SELECT CAST(o_custkey AS VARCHAR) AS user_id, o_orderpriority AS workout_type,
        o_orderdate AS start_date, o_orderkey FROM orders))"""


def q_odd_dates(spark, sf):
    """Dates without an offset, without leading zeros, without meaning and left out."""
    kind, start, end = F.col("row_id") % 6, F.col("start_date"), F.col("end_date")
    plain = "yyyy-MM-dd HH:mm:ss"
    starts = F.when(kind == 1, F.date_format(start, plain)).when(kind == 2, "2024-13-45 10:00:00 -0300").when(kind == 3, "").otherwise(
        F.concat(F.date_format(start, plain), F.lit(" -0300")))
    ends = F.when(kind == 4, "some time later").otherwise(F.date_format(end, plain))
    elements = export_xml.parse_record_elements(fx.record_xml(spark, sf, start=starts, end=ends), "xml")
    good, bad = export_xml.readable(export_xml.conform_records(elements, later(), F.lit("upload.zip")))
    columns = ("user_id", "type", "start_date", "end_date", "value")
    return shown(good.select(*columns, F.lit(True).alias("stored")).unionByName(bad.select(*columns, F.lit(False).alias("stored"))))


ODD_DATES_SQL = with_records(fx.movement(), f"""SELECT user_id, type,
    CASE WHEN row_id % 6 NOT IN (2, 3) THEN strftime(start_date, '%Y-%m-%d %H:%M:%S') || '.000000' END AS start_date,
    CASE WHEN row_id % 6 <> 4 THEN strftime(end_date, '%Y-%m-%d %H:%M:%S') || '.000000' END AS end_date,
    {rounded('value')}, row_id % 6 NOT IN (2, 3) AS stored FROM records""")

ODD_TEXTS = {"click": "12.5", "view": "abc", "purchase": "", "signup": "1e3", "error": " 7 "}
ODD_VALUES = {"click": 12.5, "view": 0.0, "purchase": 0.0, "signup": 1000.0, "error": 7.0}


def q_odd_values(spark, sf):
    """Values that are no numbers are 0.0."""
    elements = export_xml.parse_record_elements(fx.record_xml(spark, sf, texts=ODD_TEXTS), "xml")
    return shown(export_xml.conform_records(elements, later(), F.lit("upload.zip")).select("user_id", "type", "start_date", "value"))


ODD_VALUES_SQL = f"""SELECT CAST(user_id AS VARCHAR) AS user_id, {fx.case_sql('event_type', fx.MOVEMENT)} AS type,
    strftime(ts, '%Y-%m-%d %H:%M:%S') || '.000000' AS start_date, CAST({fx.case_sql('event_type', ODD_VALUES)} AS DOUBLE) AS value FROM events"""


# ------------------------------------------------------------ whole pipeline


def q_ingest_counters(spark, sf):
    """Elements read by a load, and by the same load again."""
    root = work_folder(spark)
    fx.write_archives(spark, sf, f"{root}/uploads")
    lake = pipeline.Lake(f"{root}/lake", record_buckets=2)
    counts = []
    for _ in range(2):
        pipeline.land(spark, lake, f"{root}/uploads", fx.USER_IN_NAME)
        counts.append(pipeline.load_silver(spark, lake, pipeline.pending(spark, lake), later()))
    return spark.createDataFrame([(kind, counts[0][kind], counts[1][kind]) for kind in counts[0]], "kind string, first long, again long")


INGEST_COUNTERS_SQL = """SELECT 'records' AS kind, COUNT(*) AS first, CAST(0 AS BIGINT) AS again FROM events
    UNION ALL SELECT 'workouts', COUNT(*), 0 FROM orders UNION ALL SELECT 'bad_archives', 0, 0"""


def q_land_and_unpack(spark, sf):
    """Archives per user, landed twice, unpacked in small parts, read back."""
    root = work_folder(spark)
    fx.write_archives(spark, sf, f"{root}/uploads")
    lake = pipeline.Lake(f"{root}/lake")
    pipeline.land(spark, lake, f"{root}/uploads", fx.USER_IN_NAME)
    pipeline.land(spark, lake, f"{root}/uploads", fx.USER_IN_NAME)
    landed = archives.read_catalog(spark, lake.bronze)
    archives.unpack_exports(landed, lake.staging, part_bytes=16 << 10).write.parquet(f"{root}/manifest")
    elements = export_xml.read_record_elements(spark, lake.staging)
    rows = export_xml.conform_records(elements, later(), F.lit("upload.zip"))
    return shown(rows.select(*RECORD_SHOWN))


def q_pipeline_activity(spark, sf):
    """Archives to gold in one call."""
    root = work_folder(spark)
    fx.write_archives(spark, sf, f"{root}/uploads")
    lake = pipeline.Lake(f"{root}/lake", record_buckets=8, gold_buckets=4)
    stored = pipeline.run_pipeline(spark, lake, "all", source=f"{root}/uploads",
                                   user_pattern=fx.USER_IN_NAME, now=later())
    return shown(stored["daily_activity_summary"].drop("updated_at"))


def q_stream_workouts(spark, sf):
    """The same by streaming ingest; workouts as they end up in gold."""
    root = work_folder(spark)
    fx.write_archives(spark, sf, f"{root}/uploads")
    lake = pipeline.Lake(f"{root}/lake", record_buckets=8, gold_buckets=4)
    ingest_archives(
        spark, lake, f"{root}/uploads", f"{root}/checkpoint", fx.USER_IN_NAME, now=later()
    ).awaitTermination()
    return shown(tables.read_gold(spark, lake.gold, "workouts_summary").drop("updated_at"))


PIPELINE_ACTIVITY_SQL = f"""WITH records AS (SELECT * REPLACE (
        date_trunc('second', start_date) AS start_date, date_trunc('second', end_date) AS end_date)
    FROM ({fx.movement().sql()}))
    SELECT {', '.join(typed_rows(['step_count', 'active_energy_kcal', 'basal_energy_kcal', 'distance_km']))}
    FROM ({ACTIVITY_BODY})"""

# ------------------------------------------------------------ coach text


def one_decimal(column: str, unit: str) -> str:
    return f"printf('%.1f', {column}) || '{unit}'"


def one_decimal_na(column: str, unit: str) -> str:
    return f"CASE WHEN {column} IS NULL OR {column} = 0 THEN 'N/A' ELSE {one_decimal(column, unit)} END"


def section_sql(table: str, n: int, order: str, heading: str, line: str) -> str:
    return f"""SELECT user_id, '{heading}' || chr(10) || string_agg(line, '' ORDER BY {order}) AS body
        FROM (SELECT *, {line} || chr(10) AS line FROM {newest(table, n, order)}) GROUP BY user_id"""


CONTEXT_SQL = f"""SELECT user_id, concat(a.body, s.body, c.body, w.body) AS context FROM
    ({section_sql(ACTIVITY, 7, 'date DESC', '### ACTIVITY SUMMARY (Last 7 Days):',
        "'- Date: ' || CAST(date AS VARCHAR) || ' | Steps: ' || format('{:,}', CAST(step_count AS BIGINT))"
        " || ' | Active Energy: ' || " + one_decimal('active_energy_kcal', ' kcal')
        + " || ' | Distance: ' || " + one_decimal('distance_km', ' km'))}) a
    FULL OUTER JOIN ({section_sql(SLEEP, 7, 'date DESC', "' || chr(10) || '### SLEEP STAGES (Last 7 Days):",
        "'- Date: ' || CAST(date AS VARCHAR) || ' | Deep: ' || " + one_decimal('deep_sleep_minutes', 'm')
        + " || ' | Light: ' || " + one_decimal('light_sleep_minutes', 'm')
        + " || ' | REM: ' || " + one_decimal('rem_sleep_minutes', 'm')
        + " || ' | Awake: ' || " + one_decimal('awake_minutes', 'm'))}) s USING (user_id)
    FULL OUTER JOIN ({section_sql(CARDIO, 7, 'date DESC', "' || chr(10) || '### CARDIOVASCULAR METRICS (Last 7 Days):",
        "'- Date: ' || CAST(date AS VARCHAR) || ' | Resting Heart Rate: ' || " + one_decimal_na('avg_resting_heart_rate', ' bpm')
        + " || ' | HRV (SDNN): ' || " + one_decimal_na('avg_hrv_sdnn', ' ms')
        + " || ' | Blood Oxygen Avg: ' || " + one_decimal_na('avg_blood_oxygen', '%'))}) c USING (user_id)
    FULL OUTER JOIN ({section_sql(WORKOUTS, 5, 'start_date DESC, workout_type', "' || chr(10) || '### RECENT WORKOUTS:",
        "'- Type: ' || workout_type || ' | Date: ' || strftime(start_date, '%Y-%m-%d %H:%M:%S') || ' | Duration: ' || "
        + one_decimal('duration_minutes', 'm') + " || ' | Energy: ' || " + one_decimal('total_energy_kcal', ' kcal')
        + " || ' | Distance: ' || " + one_decimal('total_distance_km', ' km'))}) w USING (user_id)"""


def q_coach_context(spark, sf):
    return serve.coach_context(
        gold_activity(spark, sf), gold_sleep(spark, sf), gold_cardio(spark, sf), gold_workouts(spark, sf)
    )


def q_report_prompt(spark, sf):
    return serve.report_prompt(q_coach_context(spark, sf))


def q_question_prompt(spark, sf):
    question = F.concat(F.lit("How did user "), F.col("user_id"), F.lit(" sleep?"))
    return serve.question_prompt(q_coach_context(spark, sf), question)


def prompt_sql(template: str, question: str = "''") -> str:
    quoted = template.replace("'", "''")
    return f"""SELECT user_id, replace(replace('{quoted}', '{{question}}', {question}), '{{context}}', context) AS prompt
        FROM ({CONTEXT_SQL})"""


# ------------------------------------------------------------ served views

KPI_SQL = f"""SELECT a.user_id, CAST(a.date AS VARCHAR) AS date, CAST(floor(step_count) AS BIGINT) AS steps,
    {rounded('active_energy_kcal', 'active_kcal')}, {rounded('distance_km')},
    {rounded('avg_resting_heart_rate', 'resting_hr')},
    CASE WHEN floor(step_count) > 0 THEN CAST(floor(step_count) - 8000 AS DOUBLE) END AS steps_vs_goal,
    CASE WHEN active_energy_kcal > 0 THEN round(active_energy_kcal - 500, 6) END AS active_kcal_vs_goal,
    round(coalesce(total_sleep_minutes, 0) / 60, 6) AS sleep_hours,
    CASE WHEN total_sleep_minutes IS NULL THEN 'No Data' ELSE printf('%.1f', total_sleep_minutes / 60) || ' hrs' END AS sleep_status,
    {one_decimal_na('avg_resting_heart_rate', ' bpm')} AS resting_hr_text,
    CASE WHEN avg_resting_heart_rate > 75 THEN 'Elevated' WHEN avg_resting_heart_rate > 0 THEN 'Good (<70)' END AS resting_hr_label
    FROM {newest(ACTIVITY, 1)} a LEFT JOIN {newest(SLEEP, 1)} s USING (user_id) LEFT JOIN {newest(CARDIO, 1)} c USING (user_id)"""

STAGE_COLUMNS = ("deep_sleep_minutes", "light_sleep_minutes", "rem_sleep_minutes", "awake_minutes")


def q_latest_kpis(spark, sf):
    kpis = serve.latest_kpis(gold_activity(spark, sf), gold_sleep(spark, sf), gold_cardio(spark, sf))
    return shown(kpis.withColumn("steps_vs_goal", F.col("steps_vs_goal").cast("double")))


SERVED = {
    # name: (Spark view, SQL)
    "steps_trend": (
        lambda s, d: serve.steps_trend(gold_activity(s, d)),
        select_sql(newest(ACTIVITY, 14), *typed_rows(["step_count"])),
    ),
    "sleep_stage_bars": (
        lambda s, d: serve.sleep_stage_bars(gold_sleep(s, d)),
        select_sql(newest(SLEEP, 14), *typed_rows(STAGE_COLUMNS)),
    ),
    "sleep_stage_bars_long": (
        lambda s, d: serve.long_form(serve.sleep_stage_bars(gold_sleep(s, d))),
        " UNION ALL ".join(
            select_sql(newest(SLEEP, 14), "user_id", day("date"), f"'{c}' AS series", rounded(c, "value"))
            for c in STAGE_COLUMNS
        ),
    ),
    "sleep_averages": (
        lambda s, d: serve.sleep_averages(gold_sleep(s, d)),
        select_sql(
            SLEEP, "user_id", "round(avg(total_sleep_minutes) / 60, 6) AS avg_sleep_hours",
            *[f"round(avg({c}), 6) AS avg_{c}" for c in STAGE_COLUMNS],
            "avg(total_sleep_minutes) / 60 >= 7.5 AS target_met", tail="GROUP BY user_id",
        ),
    ),
    "sleep_stage_trend": (
        lambda s, d: serve.sleep_stage_trend(gold_sleep(s, d)),
        select_sql(SLEEP, *typed_rows(STAGE_COLUMNS[:3])),
    ),
    "energy_trend": (
        lambda s, d: serve.energy_trend(gold_activity(s, d)),
        select_sql(ACTIVITY, *typed_rows(["active_energy_kcal", "basal_energy_kcal"])),
    ),
    "distance_trend": (
        lambda s, d: serve.distance_trend(gold_activity(s, d)),
        select_sql(ACTIVITY, *typed_rows(["distance_km"])),
    ),
    "heart_trend": (
        lambda s, d: serve.heart_trend(gold_cardio(s, d)),
        select_sql(CARDIO, *typed_rows(["avg_resting_heart_rate", "avg_hrv_sdnn"])),
    ),
    "oxygen_trend": (
        lambda s, d: serve.oxygen_trend(gold_cardio(s, d)),
        select_sql(CARDIO, *typed_rows(["avg_blood_oxygen", "avg_vo2_max"])),
    ),
    "respiratory_trend": (
        lambda s, d: serve.respiratory_trend(gold_breath(s, d)),
        select_sql(BREATH, *typed_rows(["avg_respiratory_rate", "avg_breathing_disturbances"])),
    ),
    "recent_respiratory": (
        lambda s, d: serve.recent_respiratory(gold_breath(s, d)),
        select_sql(newest(BREATH, 15), *typed_rows([
            "avg_respiratory_rate", "min_respiratory_rate", "max_respiratory_rate", "avg_breathing_disturbances"])),
    ),
    "workout_type_distribution": (
        lambda s, d: serve.workout_type_distribution(gold_workouts(s, d)),
        select_sql(WORKOUTS, "user_id", "workout_type", "COUNT(*) AS sessions", tail="GROUP BY user_id, workout_type"),
    ),
    "workout_totals": (
        lambda s, d: serve.workout_totals(gold_workouts(s, d)),
        select_sql(
            WORKOUTS, "user_id", "round(sum(duration_minutes) / 60, 6) AS total_hours",
            "round(avg(duration_minutes), 6) AS avg_duration_minutes",
            "round(sum(total_energy_kcal), 6) AS total_energy_kcal", "COUNT(*) AS sessions", tail="GROUP BY user_id",
        ),
    ),
    "latest_per_user": (
        lambda s, d: latest_per_user(gold_sleep(s, d)),
        select_sql(newest(SLEEP, 1), *typed_rows(["total_sleep_minutes", "asleep_minutes", *STAGE_COLUMNS])),
    ),
}


# ------------------------------------------------------------ exploration

def half_away(expression: str, digits: int) -> str:
    return f"round(({expression}) * {10 ** digits}) / {10 ** digits}.0"


EXPLORED = {
    "explore_available_types": (
        lambda s, d: explore.available_types(movement(s, d)),
        with_records(fx.movement(), f"""SELECT type, COUNT(*) AS records, CAST(MIN(date) AS VARCHAR) AS first_date,
            CAST(MAX(date) AS VARCHAR) AS last_date FROM records GROUP BY type"""),
    ),
    "explore_heart_rate_sample": (
        lambda s, d: explore.heart_rate_sample(fx.by_event_type(fx.PULSE).frame(s, d)),
        with_records(fx.by_event_type(fx.PULSE), f"""SELECT {clock('creation_date')}, value, unit, source_name
            FROM (SELECT * FROM records WHERE type = 'heart_rate'
                ORDER BY creation_date, user_id, source_name, value, unit LIMIT 10)"""),
    ),
    "explore_oxygen_by_day": (
        lambda s, d: explore.oxygen_by_day(fx.by_event_type(fx.CARDIO).frame(s, d)),
        with_records(fx.by_event_type(fx.CARDIO), f"""SELECT {day('date')}, avg_oxygen_percentage, readings FROM (
            SELECT date, {half_away('AVG(value) * 100', 2)} AS avg_oxygen_percentage, COUNT(*) AS readings
            FROM records WHERE type = 'blood_oxygen' GROUP BY date ORDER BY date DESC LIMIT 10)"""),
    ),
    "explore_respiratory_range": (
        lambda s, d: explore.respiratory_range(fx.by_event_type(fx.BREATH).frame(s, d)),
        with_records(fx.by_event_type(fx.BREATH), f"""SELECT MIN(value) AS min_respiratory_rate,
            MAX(value) AS max_respiratory_rate, {half_away('AVG(value)', 1)} AS avg_respiratory_rate
            FROM records WHERE type = 'respiratory_rate'"""),
    ),
    "explore_workouts_by_type": (
        lambda s, d: explore.workouts_by_type(fx.workouts(s, d)),
        f"""SELECT workout_type, COUNT(*) AS total_workouts, {half_away('AVG(duration)', 1)} AS avg_duration_min,
            {half_away('SUM(total_energy_burned)', 0)} AS total_energy_kcal FROM ({fx.WORKOUTS_SQL}) GROUP BY workout_type""",
    ),
    "explore_records_by_type": (
        lambda s, d: explore.records_by_type(movement(s, d)),
        with_records(fx.movement(), "SELECT type, COUNT(*) AS total_records FROM records GROUP BY type"),
    ),
}


# ------------------------------------------------------------ gold tables

def gold_query(builder, view):
    return lambda spark, sf: shown(builder(view.frame(spark, sf)))


GOLD = {
    "daily_heart_rate": (
        gold_query(gold.daily_heart_rate, fx.by_event_type(fx.PULSE)),
        select_sql(table_sql(fx.by_event_type(fx.PULSE), HEART_RATE_BODY), *HEART_SHOWN),
    ),
    "daily_activity": (
        gold_query(gold.daily_activity, fx.movement()),
        select_sql(table_sql(fx.movement(), ACTIVITY_BODY),
                   *typed_rows(["step_count", "active_energy_kcal", "basal_energy_kcal", "distance_km"])),
    ),
    "daily_sleep": (
        gold_query(gold.daily_sleep, fx.sleep_view()),
        select_sql(SLEEP, *typed_rows(["total_sleep_minutes", "asleep_minutes", *STAGE_COLUMNS])),
    ),
    "daily_cardiovascular": (
        gold_query(gold.daily_cardiovascular, fx.by_event_type(fx.CARDIO)),
        select_sql(table_sql(fx.by_event_type(fx.CARDIO), CARDIO_BODY), *typed_rows([
            "avg_resting_heart_rate", "avg_hrv_sdnn", "avg_vo2_max", "avg_blood_oxygen", "min_blood_oxygen"])),
    ),
    "daily_respiratory": (
        gold_query(gold.daily_respiratory, fx.by_event_type(fx.BREATH)),
        select_sql(BREATH, *typed_rows([
            "avg_respiratory_rate", "min_respiratory_rate", "max_respiratory_rate", "avg_breathing_disturbances"])),
    ),
    "daily_metrics": (
        gold_query(gold.daily_metrics, fx.body_view()),
        select_sql(table_sql(fx.body_view(), METRICS_BODY), *typed_rows([
            "body_mass_kg", "flights_climbed", "time_in_daylight_minutes", "avg_walking_speed_kmh",
            "avg_wrist_temperature_c", "exercise_time_minutes", "avg_physical_effort"]), "stand_hours"),
    ),
    "workouts_summary": (
        lambda spark, sf: shown(gold_workouts(spark, sf)),
        select_sql(WORKOUTS, "user_id", "workout_type", clock("start_date"), clock("end_date"),
                   *[rounded(c) for c in ("duration_minutes", "total_energy_kcal", "total_distance_km")]),
    ),
}

GOLD_WORKOUT_SHOWN = ("user_id", "workout_type", clock("start_date"), clock("end_date"),
                      *[rounded(c) for c in ("duration_minutes", "total_energy_kcal", "total_distance_km")])

OPERATORS = {
    "suppress_overlaps": (
        q_suppress_overlaps,
        with_records(fx.movement(), f"""SELECT row_id, user_id, type, source_name, {clock('start_date')},
            {clock('end_date')}, {rounded('value')} FROM records p1 WHERE {SURVIVES}"""),
    ),
    "full_outer_by_key": (
        q_full_outer_by_key,
        with_records(fx.movement(), f"""SELECT {', '.join(typed_rows(['steps', 'km', 'flights', 'active_kcal', 'basal_kcal']))}
            FROM ({daily_figures('step_count', 'SUM(value) AS steps')}) s
            FULL OUTER JOIN ({daily_figures('distance', 'SUM(value) AS km')}) d USING (user_id, date)
            FULL OUTER JOIN ({daily_figures('flights_climbed', 'SUM(value) AS flights')}) f USING (user_id, date)
            FULL OUTER JOIN ({daily_figures('active_energy', 'SUM(value) AS active_kcal')}) a USING (user_id, date)
            FULL OUTER JOIN ({daily_figures('basal_energy', 'SUM(value) AS basal_kcal')}) b USING (user_id, date)"""),
    ),
    "dedup_keep_first": (q_dedup_keep_first, with_records(fx.movement(), DEDUP_BODY)),
    "merge_into_silver": (q_merge_into_silver, with_records(fx.movement(), DEDUP_BODY)),
    "merge_new_keys": (q_merge_new_keys, with_records(fx.movement(), DEDUP_BODY)),
    "merge_backdated": (q_merge_backdated, with_records(fx.movement(), DEDUP_BODY)),
    "read_silver": (
        q_read_silver,
        with_records(fx.movement(), f"""SELECT user_id, type, source_name, {clock('start_date')}, {clock('end_date')},
            {rounded('value')} FROM records WHERE type IN ('step_count', 'distance')
            AND user_id IN (SELECT username FROM ({fx.USERS_SQL}))"""),
    ),
    "upsert_by_key": (q_upsert_by_key, UPSERT_SQL),
    "upsert_gold": (q_upsert_gold, UPSERT_SQL),
    "store_all_gold": (q_store_all_gold, STORED_GOLD_SQL),
    "gold_two_writers": (q_gold_two_writers, UPSERT_SQL),
    "empty_batch": (q_empty_batch, f"SELECT {', '.join(HEART_SHOWN)}, '{fx.INGESTED}' AS updated_at "
                                   f"FROM {table_sql(fx.by_event_type(fx.PULSE), HEART_RATE_BODY)} g"),
    "gold_refusals": (q_gold_refusals, GOLD_REFUSALS_SQL),
    "changed_days": (q_changed_days, CHANGED_DAYS_SQL),
    "stored_states": (q_stored_states, select_sql(table_sql(fx.by_event_type(fx.PULSE), HEART_RATE_BODY), *HEART_SHOWN)),
    "merged_states": (q_merged_states, MERGED_STATES_SQL),
    "quarantined_workouts": (q_quarantined_workouts, QUARANTINED_WORKOUTS_SQL),
    "odd_dates": (q_odd_dates, ODD_DATES_SQL),
    "odd_values": (q_odd_values, ODD_VALUES_SQL),
    "ingest_counters": (q_ingest_counters, INGEST_COUNTERS_SQL),
    "insert_if_absent": (
        q_insert_if_absent,
        f"""WITH known AS ({fx.USERS_SQL}) SELECT username, {clock('created_at')} FROM (
            SELECT * FROM known UNION ALL
            SELECT username, TIMESTAMP '{fx.REINGESTED}' FROM (
                SELECT CAST(user_id AS VARCHAR) AS username FROM events
                UNION SELECT CAST(o_custkey AS VARCHAR) FROM orders)
            WHERE username NOT IN (SELECT username FROM known))""",
    ),
    "require_known_users": (
        q_require_known_users,
        select_sql(WORKOUTS, *GOLD_WORKOUT_SHOWN, f"user_id IN (SELECT username FROM ({fx.USERS_SQL})) AS known"),
    ),
    "top_n_per_user": (
        q_top_n_per_user,
        select_sql(newest(WORKOUTS, 5, "start_date DESC, workout_type"), *GOLD_WORKOUT_SHOWN),
    ),
    "parse_records_xml": (q_parse_records_xml, parsed_sql(fx.movement())),
    "parse_sleep_xml": (q_parse_sleep_xml, parsed_sql(fx.sleep_view())),
    "parse_workouts_xml": (q_parse_workouts_xml, PARSED_WORKOUTS_SQL),
    "land_and_unpack": (q_land_and_unpack, parsed_sql(fx.movement())),
    "pipeline_activity": (q_pipeline_activity, PIPELINE_ACTIVITY_SQL),
    "stream_workouts": (q_stream_workouts, select_sql(WORKOUTS, *GOLD_WORKOUT_SHOWN)),
    "latest_kpis": (q_latest_kpis, KPI_SQL),
    "coach_context": (q_coach_context, CONTEXT_SQL),
    "report_prompt": (q_report_prompt, prompt_sql(serve.REPORT_TEMPLATE)),
    "question_prompt": (
        q_question_prompt, prompt_sql(serve.QUESTION_TEMPLATE, "'How did user ' || user_id || ' sleep?'")
    ),
}


def _all() -> dict[str, tuple[Callable, str]]:
    def showing(view):
        return lambda spark, sf: shown(view(spark, sf))

    views = {name: (showing(view), sql) for name, (view, sql) in {**SERVED, **EXPLORED}.items()}
    return {**GOLD, **OPERATORS, **views}


def entry(spark: SparkSession) -> DataFrame:
    """Daily activity with overlap suppression, the flagship."""
    return GOLD["daily_activity"][0](spark, TEST_DATA)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: query for name, (query, _) in _all().items()}
    if training_data:
        found |= {**training_data.QUERIES, "pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = {name: sql for name, (_, sql) in _all().items()}
    if training_data:
        found |= training_data.SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
