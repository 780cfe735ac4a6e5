"""Batches of a stream are noted and worked off together, their archives listed by tasks."""

import zipfile

import pytest

from vitals.plans.pipeline import Lake
from vitals.sources import tables
from vitals.streaming import ingest, ingest_archives

RECORD = '<Record type="HKQuantityTypeIdentifierStepCount" startDate="2024-01-05 07:03:02" endDate="2024-01-05 07:04:02" sourceName="Watch" value="{}"/>'


@pytest.fixture
def stream(spark, tmp_path, monkeypatch):
    """Runs a stream of two files a batch; gives the stored steps by user. ``loads`` counts how often silver was loaded."""
    lake, load_silver = Lake(str(tmp_path / "lake"), record_buckets=2, gold_buckets=2), ingest.load_silver

    def counted(*arguments):
        run.loads += 1
        return load_silver(*arguments)

    def run(users, **options):
        for user in users:
            folder = tmp_path / "in" / f"user{user}"
            folder.mkdir(parents=True)
            with zipfile.ZipFile(folder / "export.zip", "w") as z:
                z.writestr("export.xml", f"<HealthData>{RECORD.format(user)}</HealthData>")
        ingest_archives(spark, lake, str(tmp_path / "in"), str(tmp_path / "checkpoint"), max_files_per_batch=2, **options).awaitTermination()
        return {r.user_id: r.step_count for r in tables.read_gold(spark, lake.gold, "daily_activity_summary").collect()}

    run.loads, run.notes = 0, tmp_path / "lake" / "staging" / "arrived"
    monkeypatch.setattr(ingest, "load_silver", counted)
    return run


def steps(n):
    return {f"user{i}": float(i) for i in range(1, n + 1)}


def test_batches_are_worked_off_together(spark, tmp_path, stream):
    assert stream(range(1, 7)) == steps(6) and stream.loads == 1  # three batches, all of them full
    listed = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "checkpoint" / "listing"))
    assert sorted(r["count"] for r in listed.groupBy("_metadata.file_path").count().collect()) == [2, 2, 2]
    assert not list(stream.notes.iterdir())
    assert stream([]) == steps(6) and stream.loads == 1
    assert stream(range(7, 10)) == steps(9) and stream.loads == 2  # the last one is not full
    assert listed.count() == 6 and spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "checkpoint" / "listing")).count() == 9


def test_nothing_to_list(stream, tmp_path):
    (tmp_path / "in").mkdir()
    assert stream([]) == {} and stream.loads == 0


def test_a_group_ends_at_its_size(stream, monkeypatch):
    monkeypatch.setattr(ingest, "GROUP_BYTES", 1)
    assert stream(range(1, 5)) == steps(4) and stream.loads == 2


def test_noted_archives_are_found_after_a_break(stream, monkeypatch):
    refresh = ingest.refresh_changed
    monkeypatch.setattr(ingest, "refresh_changed", lambda *arguments: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        stream(range(1, 3))
    assert list(stream.notes.iterdir())
    monkeypatch.setattr(ingest, "refresh_changed", refresh)
    assert stream([]) == steps(2) and not list(stream.notes.iterdir())


def test_a_stream_that_goes_on_works_off_every_batch(spark, tmp_path, monkeypatch):
    worked = []
    monkeypatch.setattr(ingest, "work_off", lambda *arguments: worked.append(1))
    for user in range(4):
        (tmp_path / "in" / f"user{user}").mkdir(parents=True)
        (tmp_path / "in" / f"user{user}" / "export.zip").write_bytes(b"x")
    query = ingest_archives(spark, Lake(str(tmp_path / "lake")), str(tmp_path / "in"), str(tmp_path / "checkpoint"), max_files_per_batch=2,
                            trigger={"processingTime": "1 second"})
    query.processAllAvailable()
    assert query.isActive and query.awaitTermination(1) is False
    query.stop()
    assert len(worked) == 2 and not query.isActive
