"""The seven gold tables, for all users at once.

Builders take silver DataFrames and return one row per gold key, without
``updated_at``; the upsert stamps it.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import minutes_between
from ..operators import Measure, daily_rollup, keep_first, suppress_overlaps
from ..schema import SLEEP_ASLEEP, SLEEP_AWAKE, SLEEP_DEEP, SLEEP_LIGHT, SLEEP_REM

#: Takes out rows overlapped by a better source.
Suppress = Callable[[DataFrame], DataFrame]

HEART_RATE = [
    Measure("avg_heart_rate", "heart_rate", "avg"),
    Measure("min_heart_rate", "heart_rate", "min"),
    Measure("max_heart_rate", "heart_rate", "max"),
    Measure("records_count", "heart_rate", "count", cast="int"),
]
CARDIOVASCULAR = [
    Measure("avg_resting_heart_rate", "resting_heart_rate", "avg"),
    Measure("avg_hrv_sdnn", "hrv", "avg"),
    Measure("avg_vo2_max", "vo2_max", "avg"),
    Measure("avg_blood_oxygen", "blood_oxygen", "avg"),
    Measure("min_blood_oxygen", "blood_oxygen", "min"),
]
RESPIRATORY = [
    Measure("avg_respiratory_rate", "respiratory_rate", "avg"),
    Measure("min_respiratory_rate", "respiratory_rate", "min"),
    Measure("max_respiratory_rate", "respiratory_rate", "max"),
    Measure("avg_breathing_disturbances", "breathing_disturbances", "avg"),
]
MOVEMENT = ("step_count", "active_energy", "basal_energy", "distance")
BODY = (
    "body_mass", "time_in_daylight", "walking_speed", "wrist_temperature",
    "exercise_time", "stand_hour", "physical_effort",
)
CLIMBED = "flights_climbed"

INTERVAL_COLUMNS = ("user_id", "type", "source_name", "start_date", "end_date", "value")


def _of_types(records: DataFrame, *metrics: str) -> DataFrame:
    """Rows of some metrics. On the stored table this prunes partitions."""
    partition = "records_type" if "records_type" in records.columns else "type"
    return records.where(F.col(partition).isin(*metrics)).select(*INTERVAL_COLUMNS)


def daily_heart_rate(records: DataFrame) -> DataFrame:
    return daily_rollup(_of_types(records, "heart_rate"), HEART_RATE)


def daily_activity(records: DataFrame, suppress: Suppress = suppress_overlaps) -> DataFrame:
    """Daily totals counting each moment once, from the best source present."""
    return daily_rollup(suppress(_of_types(records, *MOVEMENT)), [
        Measure("step_count", "step_count", "sum", default=0.0),
        Measure("active_energy_kcal", "active_energy", "sum", default=0.0),
        Measure("basal_energy_kcal", "basal_energy", "sum", default=0.0),
        Measure("distance_km", "distance", "sum", default=0.0),
    ])


def daily_sleep(records: DataFrame) -> DataFrame:
    """Minutes per sleep stage on the day a stage starts.

    In-bed time and other codes add no minutes but make the day appear.
    """
    minutes = minutes_between(F.col("start_date"), F.col("end_date"))

    def spent(code: float) -> Column:
        return F.coalesce(F.sum(F.when(F.col("value") == code, minutes).otherwise(0.0)), F.lit(0.0))

    return (
        _of_types(records, "sleep")
        .withColumn("date", F.col("start_date").cast("date"))
        .where(F.col("date").isNotNull())
        .groupBy("user_id", "date")
        .agg(
            spent(SLEEP_ASLEEP).alias("asleep_minutes"),
            spent(SLEEP_DEEP).alias("deep_sleep_minutes"),
            spent(SLEEP_LIGHT).alias("light_sleep_minutes"),
            spent(SLEEP_REM).alias("rem_sleep_minutes"),
            spent(SLEEP_AWAKE).alias("awake_minutes"),
        )
        .select(
            "user_id", "date",
            (
                F.col("asleep_minutes") + F.col("deep_sleep_minutes")
                + F.col("light_sleep_minutes") + F.col("rem_sleep_minutes")
            ).alias("total_sleep_minutes"),
            "asleep_minutes", "deep_sleep_minutes", "light_sleep_minutes",
            "rem_sleep_minutes", "awake_minutes",
        )
    )


def daily_cardiovascular(records: DataFrame) -> DataFrame:
    metrics = [m.metric for m in CARDIOVASCULAR]
    return daily_rollup(_of_types(records, *metrics), CARDIOVASCULAR)


def daily_respiratory(records: DataFrame) -> DataFrame:
    return daily_rollup(_of_types(records, "respiratory_rate", "breathing_disturbances"), RESPIRATORY)


def daily_metrics(records: DataFrame, suppress: Suppress = suppress_overlaps) -> DataFrame:
    """Body, movement and environment measures.

    Stand hours count distinct starts of rows with value 0.0, the code every
    stand-hour text gets; days without any show 0, other gaps stay NULL.
    """
    rows = _of_types(records, *BODY).unionByName(suppress(_of_types(records, CLIMBED)))
    return daily_rollup(rows, [
        Measure("body_mass_kg", "body_mass", "avg"),
        Measure("flights_climbed", "flights_climbed", "sum"),
        Measure("time_in_daylight_minutes", "time_in_daylight", "sum"),
        Measure("avg_walking_speed_kmh", "walking_speed", "avg"),
        Measure("avg_wrist_temperature_c", "wrist_temperature", "avg"),
        Measure("exercise_time_minutes", "exercise_time", "sum"),
        Measure("stand_hours", "stand_hour", "count_distinct", value="start_date",
                only=F.col("value") == 0.0, default=0, cast="int"),
        Measure("avg_physical_effort", "physical_effort", "avg"),
    ])


def workouts_summary(workouts: DataFrame) -> DataFrame:
    """One row per workout type and start: the one ingested first."""
    sessions = workouts.select(
        "user_id", "workout_type", "start_date", "end_date",
        F.col("duration").alias("duration_minutes"),
        F.col("total_energy_burned").alias("total_energy_kcal"),
        F.col("total_distance").alias("total_distance_km"),
        "ingested_at", "source_name",
    )
    first = keep_first(
        sessions, ("user_id", "workout_type", "start_date"), ("ingested_at", "source_name", "end_date")
    )
    return first.drop("ingested_at", "source_name")


def build_gold(records: DataFrame, workouts: DataFrame) -> dict[str, DataFrame]:
    """All gold tables by name, in load order."""
    return {
        "daily_heart_rate_summary": daily_heart_rate(records),
        "daily_activity_summary": daily_activity(records),
        "workouts_summary": workouts_summary(workouts),
        "daily_sleep_summary": daily_sleep(records),
        "daily_cardiovascular_summary": daily_cardiovascular(records),
        "daily_respiratory_summary": daily_respiratory(records),
        "daily_metrics_summary": daily_metrics(records),
    }
