"""A hand-written export with one element per rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitals.functions import fixed1, local_timestamp, measure_value, source_priority
from vitals.sources import export_xml
from vitals.sources.archives import part_name



def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")


Q = "HKQuantityTypeIdentifier"


def record(kind, value=None, start="2024-01-05 07:03:02 -0300", end="2024-01-05 07:13:02 -0300", extra=""):
    val = "" if value is None else f' value="{value}"'
    return f'<Record type="{kind}"{val} startDate="{start}" endDate="{end}" creationDate="{end}" {extra}/>'


GOLDEN = f"""<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE HealthData [
<!ELEMENT HealthData (Record|Correlation|Workout)*>
<!ATTLIST Record type CDATA #REQUIRED>
]>
<HealthData locale="en_US">
 <ExportDate value="2024-02-01 10:00:00 -0300"/>
 {record(Q + 'HeartRate', '61.5', extra='sourceName="My &quot;Watch&quot; &amp; &gt; co" unit="count/min" device="&lt;d&gt;"')}
 {record(Q + 'HeartRate', 'abc', extra='sourceName="bad"')}
 {record(Q + 'HeartRate', None, extra='sourceName="missing"')}
 {record(Q + 'HeartRate', '', extra='sourceName="empty"')}
 {record(Q + 'HeartRate', '1_000.5', extra='sourceName="grouped"')}
 {record(Q + 'HeartRate', '1.0d', extra='sourceName="java"')}
 {record(Q + 'HeartRate', ' 2e1 ', extra='sourceName="padded"')}
 {record(Q + 'HeartRate', 'inf', extra='sourceName="inf"')}
 {record(Q + 'Unmapped', '1')}
 {record('HKCategoryTypeIdentifierAppleStandHour', 'HKCategoryValueAppleStandHourStood')}
 {record('HKCategoryTypeIdentifierSleepAnalysis', 'HKCategoryValueSleepAnalysisAsleepDeep', extra='sourceName="deep"')}
 {record('HKCategoryTypeIdentifierSleepAnalysis', 'HKCategoryValueSleepAnalysisAsleepCore', extra='sourceName="core"')}
 {record('HKCategoryTypeIdentifierSleepAnalysis', 'SomeLightSleep', extra='sourceName="light"')}
 {record('HKCategoryTypeIdentifierSleepAnalysis', 'HKCategoryValueSleepAnalysisAsleepREM', extra='sourceName="rem"')}
 {record('HKCategoryTypeIdentifierSleepAnalysis', 'HKCategoryValueSleepAnalysisAwake', extra='sourceName="awake"')}
 {record('HKCategoryTypeIdentifierSleepAnalysis', 'HKCategoryValueSleepAnalysisAsleep', extra='sourceName="asleep"')}
 {record('HKCategoryTypeIdentifierSleepAnalysis', 'HKCategoryValueSleepAnalysisInBed', extra='sourceName="inbed"')}
 {record('HKCategoryTypeIdentifierSleepAnalysis', 'deep', extra='sourceName="case"')}
 {record('HKCategoryTypeIdentifierSleepAnalysis', None, extra='sourceName="none"')}
 {record(Q + 'StepCount', '10', start='2024-1-5 7:3:2 +0000', extra='sourceName="unpadded"')}
 {record(Q + 'StepCount', '10', start='nonsense here', extra='sourceName="broken"')}
 {record(Q + 'StepCount', '10', start='2024-01-05T07:03:02', extra='sourceName="iso"')}
 {record(Q + 'StepCount', '10', end='2024-13-05 07:03:02 +0000', extra='sourceName="bad end"')}
 <Correlation type="x">
  {record(Q + 'BodyMass', '70', extra='sourceName="wrapped"')}
 </Correlation>
 <Record type="{Q}BodyMass" value="71" sourceName="many lines" unit="null"
   startDate="2024-01-05 07:03:02 -0300" endDate="2024-01-05 07:03:02 -0300">
  <MetadataEntry key="a" value="b"/>
  <MetadataEntry key="c" value="d"/>
 </Record>
 <Workout workoutActivityType="Plain" duration="30.5" durationUnit="" totalDistance="5" totalDistanceUnit="mi"
   totalEnergyBurned="" startDate="2024-01-05 07:00:00 -0300" endDate="2024-01-05 07:30:30 -0300"/>
 <Workout workoutActivityType="Energy" totalEnergyBurned="1" totalEnergyBurnedUnit="kJ"
   startDate="2024-01-05 08:00:00 -0300" endDate="2024-01-05 08:30:00 -0300">
  <WorkoutStatistics type="{Q}ActiveEnergyBurned" sum="250.5"/>
 </Workout>
 <Workout workoutActivityType="Distances" duration="10" startDate="2024-01-05 09:00:00 -0300" endDate="2024-01-05 09:30:00 -0300">
  <WorkoutStatistics type="{Q}DistanceCycling" sum="3" unit="mi"/>
  <WorkoutStatistics type="{Q}DistanceSwimming" sum="700" unit="m"/>
  <WorkoutStatistics type="{Q}DistanceRowing" unit="km"/>
  <WorkoutStatistics type="{Q}HeartRate" sum="99" unit="x"/>
 </Workout>
 <Workout workoutActivityType="BadSum" totalDistance="4" startDate="2024-01-05 10:00:00 -0300" endDate="2024-01-05 10:30:00 -0300">
  <WorkoutStatistics type="{Q}DistanceCycling" sum="x" unit="mi"/>
 </Workout>
 <Workout workoutActivityType="Unreadable" duration="ten" startDate="2024-01-05 11:00:00 -0300" endDate="2024-01-05 11:30:00 -0300"/>
</HealthData>
"""


@pytest.fixture(scope="module")
def staged(tmp_path_factory):
    folder = tmp_path_factory.mktemp("staged")
    (folder / part_name("user/1 ü", "abc", 0)).write_text(GOLDEN)
    return str(folder)


@pytest.fixture(scope="module")
def records(spark, staged):
    rows = export_xml.conform_records(
        export_xml.read_record_elements(spark, staged), now(), F.concat(F.col("sha256"), F.lit(".zip")))
    return rows.cache()


def by_source(rows, column="value"):
    return {r.source_name: r[column] for r in rows.collect()}


def test_values(records):
    got = by_source(records.where("type = 'heart_rate'"))
    assert got == {
        'My "Watch" & > co': 61.5, "bad": 0.0, "missing": 0.0, "empty": 0.0, "grouped": 1000.5,
        "java": 0.0, "padded": 20.0, "inf": float("inf"),
    }


def test_sleep_codes(records):
    assert by_source(records.where("type = 'sleep'")) == {
        "deep": 2.0, "core": 3.0, "light": 3.0, "rem": 4.0, "awake": 5.0, "asleep": 1.0,
        "inbed": 0.0, "case": 0.0, "none": 0.0,
    }


def test_category_text_counts_as_zero_unless_coded(spark, staged, records):
    assert [r.value for r in records.where("type = 'stand_hour'").collect()] == [0.0]
    coded = export_xml.conform_records(
        export_xml.read_record_elements(spark, staged), now(), F.lit("f"),
        category_codes={"stand_hour": {"HKCategoryValueAppleStandHourStood": 1}})
    assert [r.value for r in coded.where("type = 'stand_hour'").collect()] == [1.0]


def test_unmapped_dropped_nested_and_long_elements_read(records):
    assert records.where("type IS NULL").count() == 0
    assert by_source(records.where("type = 'body_mass'")) == {"wrapped": 70.0, "many lines": 71.0}
    assert by_source(records.where("type = 'body_mass'"), "unit") == {"wrapped": "", "many lines": "null"}


def test_dates_keep_the_wall_clock(records):
    steps = records.where("type = 'step_count'")
    seven = dt.datetime(2024, 1, 5, 7, 3, 2)
    assert by_source(steps, "start_date") == {"unpadded": seven, "broken": None, "iso": seven, "bad end": seven}
    assert by_source(steps, "end_date")["bad end"] is None
    assert by_source(steps, "date")["iso"] == dt.date(2024, 1, 5)


def test_quarantine_and_lineage(records):
    good, bad = export_xml.readable(records)
    assert [r.source_name for r in bad.collect()] == ["broken"]
    row = good.where("type = 'heart_rate'").first()
    assert (row.user_id, row.file_source, row.ingested_at) == ("user/1 ü", "abc.zip", dt.datetime(2024, 6, 1))
    first = records.where("value = 61.5").first()
    assert (first.device, first.unit, first.source_version) == ("<d>", "count/min", "")


def test_workouts(spark, staged):
    rows = export_xml.conform_workouts(export_xml.read_workout_elements(spark, staged), now(), F.lit("f"))
    good, bad = export_xml.readable(rows)
    assert [r.workout_type for r in bad.collect()] == ["Unreadable"]
    got = {
        r.workout_type: (r.duration, r.duration_unit, r.total_distance, r.total_distance_unit,
                         r.total_energy_burned, r.total_energy_burned_unit)
        for r in good.collect()
    }
    assert got == {
        "Plain": (30.5, "", 5.0, "mi", 0.0, "kcal"),
        "Energy": (0.0, "min", 0.0, "km", 250.5, "kcal"),
        "Distances": (10.0, "min", 700.0, "m", 0.0, "kcal"),
        "BadSum": (0.0, "min", 0.0, "mi", 0.0, "kcal"),
    }


def test_broken_document_fails(spark, tmp_path):
    (tmp_path / part_name("u", "a", 0)).write_text('<HealthData><Record type="x" value="1" <</HealthData>')
    with pytest.raises(Exception):
        export_xml.read_record_elements(spark, str(tmp_path)).collect()


def test_element_strings(spark):
    df = spark.createDataFrame([("u", record(Q + "HeartRate", "5", extra='sourceName="s"'))], "user_id string, xml string")
    row = export_xml.conform_records(export_xml.parse_record_elements(df, "xml"), now(), F.lit("f")).first()
    assert (row.type, row.value, row.source_name, row.start_date) == ("heart_rate", 5.0, "s", dt.datetime(2024, 1, 5, 7, 3, 2))


# ------------------------------------------------------------ column functions


def test_numbers_read_like_python(spark):
    texts = ["1", "-2.5", "+3", "1.", ".5", "1e3", "1_0", "1__0", "_1", "1_", "inf", "-Infinity", "nan", "-nan",
             "0x10", "1f", "", " ", "1 2", " 7\t", "1,5", "1e", "e1", "--1"]

    def python(text):
        try:
            return float(text)
        except ValueError:
            return 0.0

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(measure_value(F.col("t"))).collect()]
    assert list(map(repr, got)) == list(map(repr, map(python, texts)))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_clock_does_not_depend_on_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-03-10 02:30:00 -0500", "2024-3-9 2:3:4", "2024-01-05", "2024-01-05T07:03:02.9-03:00",
                 "2024-01-05  07:03:02 x", "2024-01-05 07:03", "2024-01-05 25:00:00", "", None, "x"]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [r[0] for r in df.select(local_timestamp(F.col("t")).cast("string")).collect()]
        assert got == ["2024-03-10 02:30:00", "2024-03-09 02:03:04", "2024-01-05 00:00:00", "2024-01-05 07:03:02",
                       None, None, None, None, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_one_decimal_like_python(spark):
    import random
    rng = random.Random(3)
    values = [0.0, 0.05, 0.15, 0.25, 0.35, 6.25, 6.75, 12.35, 1e-9, 0.04999999999999999, 0.95, 9.95, 99.95,
              1e6 + 0.25, 123456789.45, -1.25, -0.35, 7.0]
    values += [round(rng.uniform(0, 500), 2) for _ in range(2000)] + [rng.uniform(0, 1e5) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(fixed1("v")).collect()]
    assert got == [f"{v:.1f}" for v in values]


def test_source_rank(spark):
    names = ["Ann's Watch", "watch", "Zepp", "Zepp Life", "", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(source_priority(F.col("n"))).collect()] == [1, 3, 2, 3, 3, 3]


def test_dates_are_read_whole(spark):
    from vitals.functions.measures import local_timestamp
    want = {
        "2024-01-05 07:03:02 +0300": "2024-01-05 07:03:02", "2024-1-5 7:3:2": "2024-01-05 07:03:02",
        "2024-01-05T07:03:02+03:00": "2024-01-05 07:03:02", "2024-01-05T07:03:02.987654Z": "2024-01-05 07:03:02",
        "20240105": "2024-01-05 00:00:00", "20240105T070302-0300": "2024-01-05 07:03:02", "2024-01-05": "2024-01-05 00:00:00",
        "2024-01-05T23": "2024-01-05 23:00:00", "2024-01-05T23:59+03": "2024-01-05 23:59:00",
        "2024-01-05T07:03:02garbage": None, "2024": None, "2024-01": None, "2024-02-30": None, "2024-01-05T25:00:00": None,
        "2024-01-05T07:03:02+3": None, "": None, "x": None, None: None,
    }
    frame = spark.createDataFrame([(t,) for t in want], "t string")
    got = {r.t: r.at for r in frame.select("t", local_timestamp(F.col("t")).cast("string").alias("at")).collect()}
    assert got == want
