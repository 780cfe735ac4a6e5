"""What a load keeps on disk while it merges."""

import datetime as dt
import os
import time
import zipfile

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from vitals.plans.pipeline import Lake, land, load_silver, pending
from vitals.session import drop_shuffles
from vitals.sources import tables

EXPORT = """<HealthData><Record type="HKQuantityTypeIdentifierStepCount" startDate="2024-01-05 07:03:02" endDate="2024-01-05 07:04:02" value="1"/>
<Workout workoutActivityType="Run" duration="1" startDate="2024-01-05 07:03:02" endDate="2024-01-05 07:04:02"/></HealthData>"""


def test_documents_are_gone_when_merging(spark, tmp_path, monkeypatch):
    for user, text in (("ann", EXPORT), ("bob", EXPORT[:-5])):
        (tmp_path / "in" / user).mkdir(parents=True)
        with zipfile.ZipFile(tmp_path / "in" / user / "export.zip", "w") as z:
            z.writestr("export.xml", text)
    lake, staged = Lake(str(tmp_path / "lake"), record_buckets=2), []
    for name in ("merge_records", "merge_workouts"):
        merge = getattr(tables, name)
        monkeypatch.setattr(tables, name, lambda *a, merge=merge, **b: (staged.extend(n for n in os.listdir(lake.staging) if n.startswith("run=")), merge(*a, **b)))
    land(spark, lake, str(tmp_path / "in"))
    stamp = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    assert load_silver(spark, lake, pending(spark, lake), stamp) == {"records": 1, "workouts": 1, "bad_archives": 1}
    assert staged == [] and pending(spark, lake).count() == 0
    assert not [name for _, _, names in os.walk(lake.staging) for name in names]
    bad = spark.read.parquet(f"{lake.quarantine}/archives").first()
    assert bad.user_id == "bob" and "ExpatError" in bad.error and "part" in bad.asDict()
    files = [str(path) for kind in ("records", "workouts", "loaded") for path in (tmp_path / "lake" / "silver" / kind).glob("**/part-*.parquet")]
    assert {pq.ParquetFile(path).metadata.row_group(0).column(0).compression for path in files} == {"ZSTD"}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toString()
    return files.count("shuffle_")


def test_used_shuffles_leave_the_disk(spark):
    spark.range(10_000).repartition(7, "id").write.format("noop").mode("overwrite").save()
    before, end = shuffle_files(spark), time.time() + 30
    assert before
    while shuffle_files(spark) >= before and time.time() < end:
        time.sleep(1)
        drop_shuffles(spark)
    assert shuffle_files(spark) < before


def test_shuffles_are_dropped_before_gold_is_stored(spark, tmp_path, monkeypatch):
    steps, append = [], tables.VersionedTable.append
    monkeypatch.setattr(tables, "drop_shuffles", lambda spark: steps.append("dropped"))
    monkeypatch.setattr(tables.VersionedTable, "append", lambda *a: (steps.append("stored"), append(*a))[1])
    rows = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0, 1.0, 1.0, 1)], tables.GOLD_SCHEMAS["daily_heart_rate_summary"].fieldNames()[:6])
    rows = rows.withColumn("records_count", F.col("records_count").cast("int"))
    tables.upsert_gold(spark, rows, str(tmp_path), "daily_heart_rate_summary", F.lit("2024-06-01"))
    assert steps == ["dropped", "stored"] and tables.read_gold(spark, str(tmp_path), "daily_heart_rate_summary").count() == 1
