"""Exploration reports over silver tables."""

from pyspark.sql import DataFrame, functions as F

from ..functions import round_half_away


def _type_column(records: DataFrame) -> str:
    """The stored table has the metric as its partition column, which costs no reading."""
    return "records_type" if "records_type" in records.columns else "type"


def _metric(records: DataFrame, name: str) -> DataFrame:
    return records.where(F.col(_type_column(records)) == name)


def available_types(records: DataFrame) -> DataFrame:
    """Rows, first and last day of each metric, over all users."""
    return records.groupBy(F.col(_type_column(records)).alias("type")).agg(
        F.count("*").alias("records"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def heart_rate_sample(records: DataFrame, n: int = 10, earliest: bool = True) -> DataFrame:
    """A few heart-rate readings: the earliest ``n``, the same on every run.

    ``earliest=False`` takes any ``n``, which reads only what it needs.
    """
    rows = _metric(records, "heart_rate")
    if earliest:
        rows = rows.orderBy("creation_date", "user_id", "source_name", "value", "unit")
    return rows.limit(n).select("creation_date", "value", "unit", "source_name")


def oxygen_by_day(records: DataFrame, days: int = 10) -> DataFrame:
    """Mean oxygen saturation in percent and readings, newest days first."""
    return (
        _metric(records, "blood_oxygen")
        .groupBy(F.col("start_date").cast("date").alias("date"))
        .agg(
            round_half_away(F.avg("value") * 100, 2).alias("avg_oxygen_percentage"),
            F.count("*").alias("readings"),
        )
        .orderBy(F.desc("date"))
        .limit(days)
    )


def respiratory_range(records: DataFrame) -> DataFrame:
    """Lowest, highest and mean respiratory rate of the whole table."""
    return _metric(records, "respiratory_rate").agg(
        F.min("value").alias("min_respiratory_rate"),
        F.max("value").alias("max_respiratory_rate"),
        round_half_away(F.avg("value"), 1).alias("avg_respiratory_rate"),
    )


def workouts_by_type(workouts: DataFrame) -> DataFrame:
    """Sessions, mean length and energy per workout type, most frequent first."""
    return (
        workouts.groupBy("workout_type")
        .agg(
            F.count("*").alias("total_workouts"),
            round_half_away(F.avg("duration"), 1).alias("avg_duration_min"),
            round_half_away(F.sum("total_energy_burned"), 0).alias("total_energy_kcal"),
        )
        .orderBy(F.desc("total_workouts"), "workout_type")
    )


def records_by_type(records: DataFrame) -> DataFrame:
    """Stored records per metric, most frequent first."""
    return (
        records.groupBy(F.col(_type_column(records)).alias("type"))
        .agg(F.count("*").alias("total_records"))
        .orderBy(F.desc("total_records"), "type")
    )
