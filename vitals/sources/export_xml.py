"""Export XML to typed silver rows.

Spark's XML source finds ``Record`` and ``Workout`` elements at any depth and
reads one document per task; ``archives.unpack_exports`` keeps documents small,
and packs the smallest into tables that say where their elements stand.
Attributes arrive as text and are typed by the functions below, which also work
on elements held as strings in a column.
"""

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import classify_sleep, local_timestamp, map_record_type, measure_value, workout_number
from ..functions.measures import number
from ..schema import (
    DISTANCE_WORD,
    ENERGY_STATISTIC,
    RECORD_SCHEMA,
    RECORD_XML_SCHEMA,
    WORKOUT_SCHEMA,
    WORKOUT_XML_SCHEMA,
)
from .archives import PACKED, PACKS
from .tables import exists

# Attribute text is kept as written: no trimming, and the word "null" is a word.
_VERBATIM = {"ignoreSurroundingSpaces": "false", "nullValue": "\u0000"}


def _read(spark: SparkSession, path: str, row_tag: str, schema: T.StructType) -> DataFrame:
    elements = (
        spark.read.format("xml")
        .schema(schema)
        .options(rowTag=row_tag, mode="FAILFAST", recursiveFileLookup="true", pathGlobFilter="*.xml", **_VERBATIM)
        .load(path)
    )
    name = F.split(F.col("_metadata.file_name"), "-")
    elements = elements.select(
        "*",
        F.decode(F.unhex(name[0]), "UTF-8").alias("user_id"),
        name[1].alias("sha256"),
    )
    packs = posixpath.join(path, PACKS)
    if not exists(spark, packs):
        return elements
    parts = spark.read.schema(PACKED).option("recursiveFileLookup", "true").parquet(packs).where(F.size(row_tag) > 0)
    texts = F.transform(row_tag, lambda at: F.substring("document", at["start"] + 1, at["length"]).cast("string"))
    packed = parts.select("user_id", "sha256", F.explode(texts).alias("xml"))
    return elements.unionByName(_parse(packed, "xml", schema, row_tag))


def read_record_elements(spark: SparkSession, path: str) -> DataFrame:
    """``Record`` elements of staged parts, attributes as text.

    ``user_id`` and ``sha256`` come from the file names (see
    ``archives.part_name``). A part that is not well-formed fails the read.
    """
    return _read(spark, path, "Record", RECORD_XML_SCHEMA)


def read_workout_elements(spark: SparkSession, path: str) -> DataFrame:
    """``Workout`` elements with their statistics, attributes as text."""
    return _read(spark, path, "Workout", WORKOUT_XML_SCHEMA)


def parse_record_elements(df: DataFrame, xml: str) -> DataFrame:
    """One ``Record`` element per row, as a string column, to attribute columns."""
    return _parse(df, xml, RECORD_XML_SCHEMA, "Record")


def parse_workout_elements(df: DataFrame, xml: str) -> DataFrame:
    """One ``Workout`` element per row, as a string column, to attribute columns."""
    return _parse(df, xml, WORKOUT_XML_SCHEMA, "Workout")


def _parse(df: DataFrame, xml: str, schema: T.StructType, row_tag: str) -> DataFrame:
    options = {"rowTag": row_tag, "mode": "FAILFAST", **_VERBATIM}
    others = [c for c in df.columns if c != xml]
    parsed = F.from_xml(F.col(xml), schema.simpleString(), options)
    # As a generator the parse runs once per row. As a plain column, later
    # filters on attributes would be pushed below it with a parse in each.
    return df.select(*others, F.inline(F.array(parsed)))


def _text(attribute: str, default: str = "") -> Column:
    return F.coalesce(F.col(attribute), F.lit(default))


def conform_records(
    elements: DataFrame,
    ingested_at: Column,
    file_source: Column,
    category_codes: dict[str, dict[str, float]] | None = None,
) -> DataFrame:
    """Typed records of mapped metrics; other elements are dropped.

    Sleep stages become codes. Any other text that is not a number becomes 0.0,
    unless ``category_codes[metric][text]`` gives it a code. A start that
    cannot be read leaves ``start_date`` and ``date`` NULL (see ``readable``).
    """
    value = F.when(
        F.col("type") == "sleep", classify_sleep(_text("_value", "0"))
    ).otherwise(measure_value(F.col("_value")))
    for metric, codes in (category_codes or {}).items():
        for text, code in codes.items():
            value = F.when((F.col("type") == metric) & (F.col("_value") == text), F.lit(float(code))).otherwise(value)
    return (
        elements.withColumn("type", map_record_type(F.col("_type")))
        .where(F.col("type").isNotNull())
        .withColumn("start_date", local_timestamp(F.col("_startDate")))
        .select(
            F.col("user_id").cast("string").alias("user_id"),
            _text("_sourceName").alias("source_name"),
            _text("_sourceVersion").alias("source_version"),
            _text("_device").alias("device"),
            _text("_unit").alias("unit"),
            local_timestamp(F.col("_creationDate")).alias("creation_date"),
            "start_date",
            local_timestamp(F.col("_endDate")).alias("end_date"),
            value.alias("value"),
            "type",
            ingested_at.cast("timestamp_ntz").alias("ingested_at"),
            file_source.alias("file_source"),
            F.col("start_date").cast("date").alias("date"),
        )
        .to(RECORD_SCHEMA)
    )


def _last_statistic(test) -> Column:
    """Last child statistic that has a sum and passes the test, or NULL."""
    matching = F.filter("WorkoutStatistics", lambda s: s["_sum"].isNotNull() & test(s["_type"]))
    return F.try_element_at(matching, F.lit(-1))


def conform_workouts(elements: DataFrame, ingested_at: Column, file_source: Column) -> DataFrame:
    """Typed workouts. Energy and distance statistics win over attributes.

    Of several matching statistics the last counts; a sum that is not a number
    counts as 0.0. Attribute numbers that cannot be read leave NULL (see
    ``readable``).
    """
    folded = elements.withColumn(
        "_energy", _last_statistic(lambda kind: kind == ENERGY_STATISTIC)
    ).withColumn(
        "_distance", _last_statistic(lambda kind: kind.contains(DISTANCE_WORD))
    )

    def measured(statistic: str, amount: str, unit: str, default_unit: str) -> tuple[Column, Column]:
        present = F.col(statistic).isNotNull()
        child = F.col(statistic)
        return (
            F.when(present, F.coalesce(number(child["_sum"]), F.lit(0.0))).otherwise(workout_number(F.col(amount))),
            F.when(present, F.coalesce(child["_unit"], F.lit(default_unit))).otherwise(_text(unit, default_unit)),
        )

    energy, energy_unit = measured("_energy", "_totalEnergyBurned", "_totalEnergyBurnedUnit", "kcal")
    distance, distance_unit = measured("_distance", "_totalDistance", "_totalDistanceUnit", "km")
    return (
        folded.withColumn("start_date", local_timestamp(F.col("_startDate")))
        .select(
            F.col("user_id").cast("string").alias("user_id"),
            _text("_workoutActivityType").alias("workout_type"),
            workout_number(F.col("_duration")).alias("duration"),
            _text("_durationUnit", "min").alias("duration_unit"),
            distance.alias("total_distance"),
            distance_unit.alias("total_distance_unit"),
            energy.alias("total_energy_burned"),
            energy_unit.alias("total_energy_burned_unit"),
            _text("_sourceName").alias("source_name"),
            _text("_sourceVersion").alias("source_version"),
            "start_date",
            local_timestamp(F.col("_endDate")).alias("end_date"),
            ingested_at.cast("timestamp_ntz").alias("ingested_at"),
            file_source.alias("file_source"),
            F.col("start_date").cast("date").alias("date"),
        )
        .to(WORKOUT_SCHEMA)
    )


def readable(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split conformed rows into usable ones and a quarantine.

    Rows without a start belong to no day; workouts need their three numbers.
    """
    required = [c for c in ("start_date", "duration", "total_distance", "total_energy_burned") if c in rows.columns]
    unreadable = F.greatest(*[F.col(c).isNull() for c in required], F.lit(False))
    return rows.where(~unreadable), rows.where(unreadable)
