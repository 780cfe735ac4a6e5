"""Table schemas, keys and fixed vocabularies."""

from pyspark.sql import types as T


def _struct(**fields):
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


STRING, DOUBLE, INT, LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
DATE, TIMESTAMP = T.DateType(), T.TimestampNTZType()

# ---------------------------------------------------------------- silver

RECORD_SCHEMA = _struct(
    user_id=STRING,
    source_name=STRING,
    source_version=STRING,
    device=STRING,
    unit=STRING,
    creation_date=TIMESTAMP,
    start_date=TIMESTAMP,
    end_date=TIMESTAMP,
    value=DOUBLE,
    type=STRING,
    ingested_at=TIMESTAMP,
    file_source=STRING,
    date=DATE,
)

WORKOUT_SCHEMA = _struct(
    user_id=STRING,
    workout_type=STRING,
    duration=DOUBLE,
    duration_unit=STRING,
    total_distance=DOUBLE,
    total_distance_unit=STRING,
    total_energy_burned=DOUBLE,
    total_energy_burned_unit=STRING,
    source_name=STRING,
    source_version=STRING,
    start_date=TIMESTAMP,
    end_date=TIMESTAMP,
    ingested_at=TIMESTAMP,
    file_source=STRING,
    date=DATE,
)

# A stored row repeats when all of these agree; the earliest ingested copy stays.
RECORD_KEYS = ("user_id", "type", "source_name", "start_date", "end_date", "value")
WORKOUT_KEYS = ("user_id", "workout_type", "source_name", "start_date", "end_date")

# ---------------------------------------------------------------- export XML

RECORD_XML_SCHEMA = T.StructType([
    T.StructField(name, STRING)
    for name in (
        "_type", "_value", "_startDate", "_endDate", "_creationDate",
        "_sourceName", "_sourceVersion", "_device", "_unit",
    )
])

WORKOUT_XML_SCHEMA = T.StructType([
    T.StructField(name, STRING)
    for name in (
        "_workoutActivityType", "_duration", "_durationUnit",
        "_totalDistance", "_totalDistanceUnit",
        "_totalEnergyBurned", "_totalEnergyBurnedUnit",
        "_sourceName", "_sourceVersion", "_startDate", "_endDate",
    )
] + [
    T.StructField(
        "WorkoutStatistics",
        T.ArrayType(_struct(_type=STRING, _sum=STRING, _unit=STRING)),
    )
])

# Vendor record identifier -> short metric name.
RECORD_TYPES = {
    "HKQuantityTypeIdentifierHeartRate": "heart_rate",
    "HKQuantityTypeIdentifierStepCount": "step_count",
    "HKQuantityTypeIdentifierDistanceWalkingRunning": "distance",
    "HKQuantityTypeIdentifierActiveEnergyBurned": "active_energy",
    "HKQuantityTypeIdentifierBasalEnergyBurned": "basal_energy",
    "HKCategoryTypeIdentifierSleepAnalysis": "sleep",
    "HKQuantityTypeIdentifierRespiratoryRate": "respiratory_rate",
    "HKQuantityTypeIdentifierOxygenSaturation": "blood_oxygen",
    "HKQuantityTypeIdentifierRestingHeartRate": "resting_heart_rate",
    "HKQuantityTypeIdentifierAppleStandTime": "stand_time",
    "HKCategoryTypeIdentifierAppleStandHour": "stand_hour",
    "HKQuantityTypeIdentifierPhysicalEffort": "physical_effort",
    "HKQuantityTypeIdentifierAppleExerciseTime": "exercise_time",
    "HKQuantityTypeIdentifierHeartRateVariabilitySDNN": "hrv",
    "HKQuantityTypeIdentifierBodyMass": "body_mass",
    "HKQuantityTypeIdentifierFlightsClimbed": "flights_climbed",
    "HKQuantityTypeIdentifierTimeInDaylight": "time_in_daylight",
    "HKQuantityTypeIdentifierWalkingSpeed": "walking_speed",
    "HKQuantityTypeIdentifierVO2Max": "vo2_max",
    "HKQuantityTypeIdentifierAppleSleepingWristTemperature": "wrist_temperature",
    "HKQuantityTypeIdentifierAppleSleepingBreathingDisturbances": "breathing_disturbances",
}

# Sleep stage codes, and the words that select them. The first
# row with a word contained in the stage text wins; no match means in bed.
SLEEP_IN_BED, SLEEP_ASLEEP, SLEEP_DEEP, SLEEP_LIGHT, SLEEP_REM, SLEEP_AWAKE = (
    0.0, 1.0, 2.0, 3.0, 4.0, 5.0,
)
SLEEP_STAGE_WORDS = (
    (("Deep",), SLEEP_DEEP),
    (("Core", "Light"), SLEEP_LIGHT),
    (("REM",), SLEEP_REM),
    (("Awake",), SLEEP_AWAKE),
    (("Asleep",), SLEEP_ASLEEP),
)

# LIKE patterns of source names, best source first. Sources that
# match none rank last.
SOURCE_RANKING = ("%Watch%", "Zepp")

# The workout statistic that carries energy, and the word that
# marks one carrying distance.
ENERGY_STATISTIC = "HKQuantityTypeIdentifierActiveEnergyBurned"
DISTANCE_WORD = "Distance"

# ---------------------------------------------------------------- gold

# Columns of the gold tables, in order.
GOLD_SCHEMAS = {
    "daily_heart_rate_summary": _struct(
        user_id=STRING, date=DATE,
        avg_heart_rate=DOUBLE, min_heart_rate=DOUBLE, max_heart_rate=DOUBLE,
        records_count=INT, updated_at=TIMESTAMP,
    ),
    "daily_activity_summary": _struct(
        user_id=STRING, date=DATE,
        step_count=DOUBLE, active_energy_kcal=DOUBLE, basal_energy_kcal=DOUBLE,
        distance_km=DOUBLE, updated_at=TIMESTAMP,
    ),
    "workouts_summary": _struct(
        user_id=STRING, workout_type=STRING, start_date=TIMESTAMP, end_date=TIMESTAMP,
        duration_minutes=DOUBLE, total_energy_kcal=DOUBLE, total_distance_km=DOUBLE,
        updated_at=TIMESTAMP,
    ),
    "daily_sleep_summary": _struct(
        user_id=STRING, date=DATE,
        total_sleep_minutes=DOUBLE, asleep_minutes=DOUBLE, deep_sleep_minutes=DOUBLE,
        light_sleep_minutes=DOUBLE, rem_sleep_minutes=DOUBLE, awake_minutes=DOUBLE,
        updated_at=TIMESTAMP,
    ),
    "daily_cardiovascular_summary": _struct(
        user_id=STRING, date=DATE,
        avg_resting_heart_rate=DOUBLE, avg_hrv_sdnn=DOUBLE, avg_vo2_max=DOUBLE,
        avg_blood_oxygen=DOUBLE, min_blood_oxygen=DOUBLE, updated_at=TIMESTAMP,
    ),
    "daily_respiratory_summary": _struct(
        user_id=STRING, date=DATE,
        avg_respiratory_rate=DOUBLE, min_respiratory_rate=DOUBLE,
        max_respiratory_rate=DOUBLE, avg_breathing_disturbances=DOUBLE,
        updated_at=TIMESTAMP,
    ),
    "daily_metrics_summary": _struct(
        user_id=STRING, date=DATE,
        body_mass_kg=DOUBLE, flights_climbed=DOUBLE, time_in_daylight_minutes=DOUBLE,
        avg_walking_speed_kmh=DOUBLE, avg_wrist_temperature_c=DOUBLE,
        exercise_time_minutes=DOUBLE, stand_hours=INT, avg_physical_effort=DOUBLE,
        updated_at=TIMESTAMP,
    ),
}

GOLD_KEYS = {
    name: ("user_id", "workout_type", "start_date") if name == "workouts_summary" else ("user_id", "date")
    for name in GOLD_SCHEMAS
}

USERS_SCHEMA = _struct(username=STRING, created_at=TIMESTAMP)

# Declared text widths; longer values break the table contract.
# Declared text widths.
GOLD_TEXT_LIMITS = {"user_id": 50, "workout_type": 100}
