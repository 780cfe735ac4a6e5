"""Archives, silver and gold folders, pipeline, streaming."""

import datetime as dt
import io
import zipfile
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from vitals.plans.pipeline import Lake, land, load_silver, pending, retry_quarantined, run_pipeline
from vitals.schema import RECORD_KEYS, RECORD_SCHEMA
from vitals.sources import archives, tables
from vitals.streaming import ingest_archives

Q = "HKQuantityTypeIdentifier"


def stamp(day):
    return F.lit(f"2024-06-{day:02d} 00:00:00").cast("timestamp_ntz")


def export(n, day=5, value=10):
    records = "\n".join(
        f' <Record type="{Q}StepCount" sourceName="Watch" value="{value + i}" '
        f'startDate="2024-01-{day:02d} {i % 24:02d}:{i // 24 % 60:02d}:00 -0300" endDate="2024-01-{day:02d} {i % 24:02d}:{i // 24 % 60:02d}:30 -0300"/>'
        for i in range(n)
    )
    workout = '<Workout workoutActivityType="Run" duration="30" startDate="2024-01-05 07:00:00 -0300" endDate="2024-01-05 07:30:00 -0300"/>'
    return f'<?xml version="1.0"?>\n<!DOCTYPE HealthData [<!ELEMENT HealthData ANY>]>\n<HealthData>\n{records}\n{workout}\n</HealthData>\n'


def put(folder, user, text, name="export.zip", member="some/dir/export.xml"):
    (folder / user).mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / user / name, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("some/other.txt", "x")
        z.writestr(member, text)


# ------------------------------------------------------------ splitting


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
@pytest.mark.parametrize("part_bytes", [1, 300, 5000, 1 << 30])
def test_split_keeps_every_element_once(monkeypatch, block, part_bytes):
    monkeypatch.setattr(archives, "BLOCK", block)
    text = export(40).replace("<Workout", "<Correlation><Record type='in'/></Correlation>\n<!-- <Record/> -->\n<Workout")
    parts = [b"".join(p) for p in archives.split_document(io.BytesIO(text.encode()), part_bytes)]
    whole = [ET.tostring(e).strip() for e in ET.fromstring(text)]
    split = [ET.tostring(e).strip() for part in parts for e in ET.fromstring(part)]
    assert split == whole
    if part_bytes == 1:
        assert len(parts) == len(whole)
    if part_bytes == 1 << 30:
        assert parts == [text.encode()]


def test_split_edges():
    def parts(raw):
        return [b"".join(p) for p in archives.split_document(io.BytesIO(raw), 10)]

    assert parts(b"<a/>") == [b"<a/>"]
    assert parts(b"\xef\xbb\xbf<a><b/></a>") == [b"\xef\xbb\xbf<a><b/></a>"]
    wide = '<?xml version="1.0" encoding="UTF-16"?><a><b c="1"/><b c="2"/></a>'.encode("utf-16")
    assert parts(wide) == [wide]
    with pytest.raises(Exception):
        parts(b"<a><b></a>")


def test_export_member():
    assert archives.export_member(["z/export.xml", "a/b/export.xml", "x.txt"]) == "z/export.xml"
    with pytest.raises(archives.ExportError):
        archives.export_member(["a/other.xml", "myexport.xml"])
    for name in ("../export.xml", "/etc/export.xml", "a/../../x", "..\\x", "c:\\x"):
        with pytest.raises(archives.ExportError):
            archives.export_member(["export.xml", name])


# ------------------------------------------------------------ landing


def test_landing_is_by_content_and_keeps_what_is_there(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    put(source, "ann", export(3))
    put(source, "bob", export(4))
    assert land(spark, lake, str(source)).count() == 2
    assert land(spark, lake, str(source)).count() == 0
    put(source, "ann", export(3), name="copy.zip")       # same bytes, other name
    (source / "ann" / "copy.zip").write_bytes((source / "ann" / "export.zip").read_bytes())
    put(source, "bob", export(9), name="newer.zip")
    added = land(spark, lake, str(source)).collect()
    assert [(r.user_id) for r in added] == ["bob"]
    catalog = archives.read_catalog(spark, lake.bronze).collect()
    assert sorted(r.user_id for r in catalog) == ["ann", "bob", "bob"]
    for row in catalog:
        assert row.sha256 in row.archive


def test_archives_without_a_safe_user_are_set_aside(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    put(tmp_path / "in", "ann", export(1))
    assert land(spark, lake, str(tmp_path / "in"), user_pattern=r"(\.)zip$").count() == 0
    assert spark.read.parquet(f"{lake.quarantine}/paths").first().error == "no safe user id in the path"
    assert land(spark, lake, str(tmp_path / "in")).count() == 1


def test_bad_archives_are_set_aside_and_hold_up_nobody(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"), record_buckets=2)
    put(source, "ann", export(3))
    put(source, "eve", export(1), member="../export.xml")
    put(source, "non", export(1), member="other.xml")
    put(source, "cut", export(60)[:-20])
    (source / "raw").mkdir()
    (source / "raw" / "export.zip").write_bytes(b"not a zip" * 100)
    (source / "wee").mkdir()
    (source / "wee" / "export.zip").write_bytes(b"no")
    land(spark, lake, str(source))
    with pytest.raises(Exception, match="outside its folder|no export.xml|unclosed|not a zip|ArrowInvalid"):
        archives.unpack_exports(pending(spark, lake), str(tmp_path / "strict"), part_bytes=500).collect()
    assert load_silver(spark, lake, pending(spark, lake), stamp(1)) == {"records": 3, "workouts": 1, "bad_archives": 5}
    reasons = {r.user_id: r.error for r in spark.read.parquet(lake.quarantine + "/archives").collect()}
    assert set(reasons) == {"eve", "non", "cut", "raw", "wee"}
    assert "outside its folder" in reasons["eve"] and "no export.xml" in reasons["non"] and "BadZipFile" in reasons["raw"]
    assert [r.user_id for r in tables.read_silver(spark, lake.records).select("user_id").distinct().collect()] == ["ann"]
    assert pending(spark, lake).count() == 0


# ------------------------------------------------------------ silver


def record_rows(spark, rows, day):
    base = dt.datetime(2024, 1, 1)
    data = [
        (user, "Watch", note, "", "", base, base + dt.timedelta(minutes=m), base + dt.timedelta(minutes=m + 1),
         value, kind, dt.datetime(2024, 6, day), "f", base.date())
        for user, kind, m, value, note in rows
    ]
    return spark.createDataFrame(data, RECORD_SCHEMA)


def stored(spark, path):
    return sorted(
        (r.user_id, r.type, r.start_date.minute, r.value, r.source_version)
        for r in tables.read_silver(spark, path).collect()
    )


def test_merge_keeps_first_and_adds_new(spark, tmp_path):
    path = str(tmp_path / "records")
    first = [("a", "hrv", 1, 1.0, "1"), ("a", "hrv", 1, 1.0, "1"), ("b", "distance", 2, 2.0, "1"), ("c", "hrv", 3, 3.0, "1")]
    tables.merge_records(spark, record_rows(spark, first, 1), path, buckets=4)
    one = [("a", "hrv", 1, 1.0, "1"), ("b", "distance", 2, 2.0, "1"), ("c", "hrv", 3, 3.0, "1")]
    assert stored(spark, path) == one
    tables.merge_records(spark, record_rows(spark, first, 2), path)
    assert stored(spark, path) == one
    changed = [("a", "hrv", 1, 1.0, "2"), ("a", "hrv", 1, 9.0, "2"), ("d", "hrv", 3, 3.0, "2")]
    tables.merge_records(spark, record_rows(spark, changed, 3), path)
    assert stored(spark, path) == sorted(one + [("a", "hrv", 1, 9.0, "2"), ("d", "hrv", 3, 3.0, "2")])
    # An older export arriving late wins over the stored copies.
    tables.merge_records(spark, record_rows(spark, [("b", "distance", 2, 2.0, "0"), ("e", "hrv", 1, 1.0, "0")], 1), path)
    assert ("b", "distance", 2, 2.0, "1") in stored(spark, path)  # same day: the stored tie stays
    earlier = record_rows(spark, [("b", "distance", 2, 2.0, "0")], 1).withColumn("ingested_at", F.lit("2024-05-01").cast("timestamp_ntz"))
    tables.merge_records(spark, earlier, path)
    assert ("b", "distance", 2, 2.0, "0") in stored(spark, path) and len(stored(spark, path)) == 6


def test_compaction_keeps_rows_in_fewer_files(spark, tmp_path):
    path = str(tmp_path / "records")
    for day in (1, 2, 3):
        tables.merge_records(spark, record_rows(spark, [("a", k, day, 1.0, "1") for k in ("hrv", "sleep")], day), path, buckets=1)
    before = stored(spark, path)
    assert len(list(tmp_path.glob("records/records_type=hrv/*/*.parquet"))) == 3
    tables.compact_records(spark, path, ["hrv"])
    assert stored(spark, path) == before and len(before) == 6
    assert len(list(tmp_path.glob("records/records_type=hrv/*/*.parquet"))) == 1
    assert len(list(tmp_path.glob("records/records_type=sleep/*/*.parquet"))) == 3


def test_bucket_number_belongs_to_the_table(spark, tmp_path):
    path = str(tmp_path / "records")
    rows = record_rows(spark, [("a", "hrv", 1, 1.0, "1")], 1)
    tables.merge_records(spark, rows, path, buckets=4)
    tables.merge_records(spark, rows, path, buckets=32)  # another wish changes nothing
    assert len(stored(spark, path)) == 1


def test_silver_read_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "records")
    tables.merge_records(spark, record_rows(spark, [("a", "hrv", 1, 1.0, "1"), ("a", "sleep", 1, 1.0, "1")], 1), path)
    plan = tables.read_silver(spark, path, types=["sleep"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "records_type" in plan.split("PartitionFilters")[1][:120]
    assert tables.read_silver(spark, path, types=["sleep"]).count() == 1


def test_null_keys_match_when_merging(spark, tmp_path):
    path = str(tmp_path / "records")
    rows = record_rows(spark, [("a", "hrv", 1, None, "1"), ("a", "hrv", 2, float("nan"), "1")], 1)
    rows = rows.withColumn("end_date", F.when(F.col("value").isNull(), None).otherwise(F.col("end_date")))
    tables.merge_records(spark, rows, path)
    tables.merge_records(spark, rows.withColumn("ingested_at", stamp(5)), path)
    assert tables.read_silver(spark, path).count() == 2


def test_merge_joins_by_equality(spark):
    rows = record_rows(spark, [("a", "hrv", 1, 1.0, "1")], 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tables._anti_null_safe(rows, rows, RECORD_KEYS)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ------------------------------------------------------------ gold


def test_gold_upsert_replaces_only_given_keys(spark, tmp_path):
    root, table = str(tmp_path), "daily_sleep_summary"
    columns = "user_id string, date date, total_sleep_minutes double, asleep_minutes double, deep_sleep_minutes double, light_sleep_minutes double, rem_sleep_minutes double, awake_minutes double"
    d = dt.date(2024, 1, 1)
    a, b = ("a", d, *[1.0] * 6), ("b", d, *[2.0] * 6)
    tables.upsert_gold(spark, spark.createDataFrame([a, b], columns), root, table, stamp(1), buckets=3)
    tables.upsert_gold(spark, spark.createDataFrame([("b", d, *[None] * 6), ("c", d, *[3.0] * 6)], columns), root, table, stamp(2))
    tables.upsert_gold(spark, spark.createDataFrame([], columns), root, table, stamp(3))
    got = {r.user_id: (r.awake_minutes, r.updated_at.day) for r in tables.read_gold(spark, root, table).collect()}
    assert got == {"a": (1.0, 1), "b": (None, 2), "c": (3.0, 2)}
    assert not list((tmp_path / table).glob("_batch/*"))


HEART = "user_id string, date date, avg_heart_rate double, min_heart_rate double, max_heart_rate double, records_count int"


def heart(spark, *rows):
    return spark.createDataFrame([(u, d and dt.date(2024, 1, d), v, v, v, 1) for u, d, v in rows], HEART)


def test_gold_sets_aside_rows_that_break_the_contract(spark, tmp_path):
    root, table = str(tmp_path / "gold"), "daily_heart_rate_summary"
    registered = spark.createDataFrame([("a",), ("b",), ("x" * 51,)], "username string")
    rows = heart(spark, ("a", 1, 1.0), ("x" * 51, 1, 2.0), (None, 1, 3.0), ("b", None, 4.0), ("b", 2, 6.0), ("b", 2, 5.0), ("c", 1, 7.0))
    for _ in range(2):  # repeating the batch adds nothing
        tables.upsert_gold(spark, rows, root, table, stamp(1), registered=registered)
        got = sorted((r.user_id, r.date.day, r.avg_heart_rate) for r in tables.read_gold(spark, root, table).collect())
        assert got == [("a", 1, 1.0), ("b", 2, 5.0)]
    assert spark.read.parquet(f"{root}_rejected/{table}").count() == 5  # put aside once
    refused = {(r.user_id, r.avg_heart_rate): r.refused for r in spark.read.parquet(f"{root}_rejected/{table}").collect()}
    assert refused == {
        ("x" * 51, 2.0): "user_id is longer than 50 characters", (None, 3.0): "user_id is missing", ("b", 4.0): "date is missing",
        ("b", 6.0): "the key is there twice", ("c", 7.0): "the user is not known"}


def broken_swap(monkeypatch, after):
    """Lets the swap into the table fail once, with the partition already taken out or not."""
    write = tables._write_partitioned

    def failing(df, path, partitions, sort, mode, **options):
        if options.get("partitionOverwriteMode"):
            monkeypatch.setattr(tables, "_write_partitioned", write)
            after(path)
            raise RuntimeError("broken off")
        write(df, path, partitions, sort, mode, **options)

    monkeypatch.setattr(tables, "_write_partitioned", failing)


def test_an_old_compaction_is_not_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "records")

    def rows(user):
        values = (user, "s", "", "", "", None, dt.datetime(2024, 1, 1), None, 1.0, "step_count", dt.datetime(2024, 6, 1), "f", dt.date(2024, 1, 1))
        return spark.createDataFrame([values], RECORD_SCHEMA)

    tables.merge_records(spark, rows("a"), path, buckets=1)
    broken_swap(monkeypatch, lambda _: None)
    with pytest.raises(RuntimeError):
        tables.compact_records(spark, path)
    tables.merge_records(spark, rows("b"), path)
    with pytest.raises(ValueError, match="no swap"):
        tables.finish_replacement(spark, path, tables.STORED_RECORDS, tables.RECORD_PARTITIONS, ("user_id", "start_date"))
    assert sorted(r.user_id for r in tables.read_silver(spark, path).collect()) == ["a", "b"]


# ------------------------------------------------------------ pipeline, streaming


def summary(frame):
    return sorted((r.user_id, str(r.date), r.step_count) for r in frame.collect())


def test_pipeline_takes_new_exports_and_repeats_nothing(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"), record_buckets=4, gold_buckets=2)
    put(source, "ann", export(3))
    put(source, "bob", export(2, day=7))
    gold = run_pipeline(spark, lake, "all", source=str(source), now=stamp(1))
    want = [("ann", "2024-01-05", 33.0), ("bob", "2024-01-07", 21.0)]
    assert summary(gold["daily_activity_summary"]) == want
    assert gold["workouts_summary"].count() == 2
    assert pending(spark, lake).count() == 0
    # Loading the same archives once more adds no rows.
    before = tables.read_silver(spark, lake.records).count()
    counts = load_silver(spark, lake, archives.read_catalog(spark, lake.bronze), stamp(2))
    assert counts == {"records": 5, "workouts": 2, "bad_archives": 0}
    assert tables.read_silver(spark, lake.records).count() == before == 5
    # A longer export of one user.
    put(source, "bob", export(4, day=7), name="later.zip")
    gold = run_pipeline(spark, lake, "all", source=str(source), now=stamp(3))
    assert summary(gold["daily_activity_summary"]) == [want[0], ("bob", "2024-01-07", 46.0)]
    with pytest.raises(ValueError):
        run_pipeline(spark, lake, "everything")


def test_stages_and_users(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"), record_buckets=4, gold_buckets=2)
    put(source, "ann", export(3))
    put(source, "bob", export(2))
    ann = spark.createDataFrame([("ann",)], "user_id string")
    run_pipeline(spark, lake, "bronze", source=str(source))
    run_pipeline(spark, lake, "silver", users=ann, now=stamp(1))
    assert [r.user_id for r in pending(spark, lake).collect()] == ["bob"]
    run_pipeline(spark, lake, "silver", now=stamp(1))
    gold = run_pipeline(spark, lake, "gold", users=ann, now=stamp(1))
    assert [r.user_id for r in gold["daily_activity_summary"].collect()] == ["ann"]
    bob = spark.createDataFrame([("bob",)], "username string")
    gold = run_pipeline(spark, Lake(lake.root, 4, 2), "gold", registered=bob, now=stamp(2))
    assert {r.user_id: r.updated_at.day for r in gold["daily_activity_summary"].collect()} == {"ann": 1, "bob": 2}
    assert [r.user_id for r in spark.read.parquet(lake.rejected + "/workouts_summary").collect()] == ["ann"]


def test_streaming_ingest(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"), record_buckets=4, gold_buckets=2)

    def run(day):
        ingest_archives(spark, lake, str(source), str(tmp_path / "checkpoint"), now=stamp(day)).awaitTermination()
        return summary(tables.read_gold(spark, lake.gold, "daily_activity_summary"))

    put(source, "ann", export(3))
    assert run(1) == [("ann", "2024-01-05", 33.0)]
    put(source, "bob", export(2, day=7))
    put(source, "ann", export(4), name="second.zip")
    assert run(2) == [("ann", "2024-01-05", 46.0), ("bob", "2024-01-07", 21.0)]
    assert run(3) == [("ann", "2024-01-05", 46.0), ("bob", "2024-01-07", 21.0)]


def test_an_archive_that_loads_later_is_not_tried_again(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"), record_buckets=2)
    put(source, "ann", export(3))
    (source / "bob").mkdir(parents=True)
    (source / "bob" / "export.zip").write_bytes(b"not an archive")
    land(spark, lake, str(source))
    land(spark, lake, str(source))
    assert load_silver(spark, lake, pending(spark, lake), stamp(1))["bad_archives"] == 1
    assert pending(spark, lake).count() == 0
    assert retry_quarantined(spark, lake) == 1
    assert [r.user_id for r in pending(spark, lake).collect()] == ["bob"]
    # What held it up is over: it holds an export now.
    put(source, "eve", export(2))
    kept = next((tmp_path / "lake" / "bronze").glob("**/bob/*.zip"), None) or next((tmp_path / "lake" / "bronze").glob("**/*bob*/*.zip"))
    kept.write_bytes((source / "eve" / "export.zip").read_bytes())
    assert load_silver(spark, lake, pending(spark, lake), stamp(2))["bad_archives"] == 0
    assert retry_quarantined(spark, lake) == 0 and pending(spark, lake).count() == 0
    assert not list((tmp_path / "lake" / "staging").glob("users/*"))


def test_paths_without_a_user_are_listed_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "export.zip").write_bytes(b"x")
    lake = Lake(str(tmp_path / "lake"))
    for _ in range(3):
        land(spark, lake, str(tmp_path / "in"), user_pattern=r"/nobody/([^/]+)/[^/]+\.zip$")
    assert spark.read.parquet(f"{lake.quarantine}/paths").count() == 1
