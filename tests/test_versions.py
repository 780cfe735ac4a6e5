"""Versioned tables: writers beside each other, breaks, compaction."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F, types as T

from vitals.sources import tables, versions
from vitals.sources.versions import Conflict, VersionedTable, create_if_absent

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("b", T.IntegerType())])


def table(spark, path, **options):
    return VersionedTable(spark, str(path), SCHEMA, ("k",), ("b",), **options)


def rows(spark, *pairs):
    return spark.createDataFrame([(k, v, k % 2) for k, v in pairs], SCHEMA)


def contents(stored):
    return dict(stored.read().select("k", "v").collect())


def test_newest_version_of_each_key(spark, tmp_path):
    stored = table(spark, tmp_path)
    assert not stored.exists() and contents(stored) == {}
    stored.append(rows(spark, (1, "a"), (2, "a"), (3, "a")))
    stored.append(rows(spark, (2, "b"), (4, "b")))
    stored.append(rows(spark, (2, None), (3, "c")))
    assert contents(stored) == {1: "a", 2: None, 3: "c", 4: "b"}


def test_one_of_many_creates_a_file(spark, tmp_path):
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda i: create_if_absent(spark, f"{tmp_path}/log/1.json", f"writer {i}" * 1000), range(16)))
    assert sum(won) == 1
    assert (tmp_path / "log" / "1.json").read_text() == f"writer {won.index(True)}" * 1000
    assert [p.name for p in (tmp_path / "log").iterdir()] == ["1.json"]


def test_without_overwriting_where_files_are_not_local(spark, tmp_path, monkeypatch):
    """The way of other file systems, tried on the local one."""
    hadoop = versions._hadoop

    class NotLocal:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return getattr(self.files, name)

        def getScheme(self):
            return "other"

    monkeypatch.setattr(versions, "_hadoop", lambda s, p: (hadoop(s, p)[0], NotLocal(hadoop(s, p)[1])))
    path = f"{tmp_path}/log/1.json"
    assert create_if_absent(spark, path, "one") and not create_if_absent(spark, path, "two")
    assert (tmp_path / "log" / "1.json").read_text() == "one"


def test_writers_beside_each_other_lose_nothing(spark, tmp_path):
    def write(i):
        table(spark, tmp_path, buckets=i).append(rows(spark, *[(100 * i + j, f"w{i}") for j in range(3)], (7, f"w{i}")))

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(write, range(1, 7)))
    stored = table(spark, tmp_path)
    got, state = contents(stored), stored.state()
    assert {k for k in got if k != 7} == {100 * i + j for i in range(1, 7) for j in range(3)}
    assert [e["version"] for e in state.live] == list(range(1, 7)) and state.options["buckets"] in range(1, 7)
    last = spark.read.parquet(f"{tmp_path}/data/{state.live[-1]['folder']}").where("k = 7").first()
    assert got[7] == last["v"]  # the later commit counts


def test_a_break_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    stored = table(spark, tmp_path)
    stored.append(rows(spark, (1, "a")))

    def broken(*_):
        raise RuntimeError("broken off")

    monkeypatch.setattr(versions, "create_if_absent", broken)
    with pytest.raises(RuntimeError):
        stored.append(rows(spark, (1, "b")), run="same")
    monkeypatch.undo()
    assert contents(stored) == {1: "a"}
    assert stored.append(rows(spark, (1, "b")), run="same") == 2
    assert stored.append(rows(spark, (1, "c")), run="same") is None  # a replay adds nothing
    assert contents(stored) == {1: "b"}


def test_a_version_between_reading_and_committing(spark, tmp_path, monkeypatch):
    """Another writer commits after this one looked: this one takes the next number."""
    mine, other = table(spark, tmp_path), table(spark, tmp_path)
    mine.append(rows(spark, (1, "a")))
    write = VersionedTable._write

    def late(self, df, run):
        folder = write(self, df, run)
        if self is mine:
            other.append(rows(spark, (2, "other")))
        return folder

    monkeypatch.setattr(VersionedTable, "_write", late)
    assert mine.append(rows(spark, (3, "mine"))) == 3
    assert contents(mine) == {1: "a", 2: "other", 3: "mine"}


def test_compaction_beside_a_writer(spark, tmp_path, monkeypatch):
    stored, other = table(spark, tmp_path), table(spark, tmp_path)
    stored.append(rows(spark, (1, "a"), (2, "a")))
    stored.append(rows(spark, (2, "b")), run="r")
    write = VersionedTable._write

    def late(self, df, run):
        folder = write(self, df, run)
        if self is stored:
            other.append(rows(spark, (1, "newer")))
        return folder

    monkeypatch.setattr(VersionedTable, "_write", late)
    assert stored.compact() is not None
    monkeypatch.undo()
    assert len(stored.state().live) == 2
    assert contents(stored) == {1: "newer", 2: "b"}
    assert stored.append(rows(spark, (2, "again")), run="r") is None  # known through compaction


def test_the_second_of_two_compactions_gives_up(spark, tmp_path, monkeypatch):
    stored, other = table(spark, tmp_path), table(spark, tmp_path)
    for v in "abc":
        stored.append(rows(spark, (1, v), (ord(v), v)))
    write = VersionedTable._write

    def late(self, df, run):
        folder = write(self, df, run)
        if self is stored:
            assert other.compact() is not None
        return folder

    monkeypatch.setattr(VersionedTable, "_write", late)
    with pytest.raises(Conflict):
        stored.compact()
    monkeypatch.undo()
    assert contents(stored) == {1: "c", **{ord(v): v for v in "abc"}}
    assert stored.compact() is None  # there is one version


def test_vacuum_takes_only_what_was_retired(spark, tmp_path):
    stored = table(spark, tmp_path)
    for v in "abc":
        stored.append(rows(spark, (1, v)))
    stored._write(rows(spark, (9, "x")), "not-committed-yet")
    stored.compact()
    assert stored.vacuum() == 3
    assert len(list((tmp_path / "data").glob("run=*"))) == 2  # the live one and the stranger's
    assert contents(stored) == {1: "c"}
    stored.append(rows(spark, (2, "d")))
    assert contents(stored) == {1: "c", 2: "d"}


def test_readers_prune_buckets_of_all_versions(spark, tmp_path):
    stored = table(spark, tmp_path)
    stored.append(rows(spark, *[(k, "a") for k in range(10)]))
    stored.append(rows(spark, *[(k, "b") for k in range(4)]))
    plan = stored.read().where(F.col("b") == 1)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("b#" in line.split("PartitionFilters:")[1].split("PushedFilters")[0] for line in scans)


def test_a_batch_writes_bytes_of_its_own_size(spark, tmp_path):
    name, root = "daily_heart_rate_summary", str(tmp_path)
    def heart(users, day):
        return spark.range(users).select(F.concat(F.lit("u"), "id").alias("user_id"), F.lit(dt.date(2024, 1, day)).alias("date"),
            F.rand(1).alias("avg_heart_rate"), F.rand(2).alias("min_heart_rate"), F.rand(3).alias("max_heart_rate"), F.lit(1).alias("records_count"))

    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    tables.upsert_gold(spark, heart(20_000, 1), root, name, now, buckets=2)
    size = lambda: sum(p.stat().st_size for p in tmp_path.rglob("*.parquet"))
    before = size()
    tables.upsert_gold(spark, heart(20, 1), root, name, now)
    assert size() - before < before / 20
    assert tables.read_gold(spark, root, name).count() == 20_000
    assert tables.compact_gold(spark, root, name) and not tables.compact_gold(spark, root, name)
    assert tables.read_gold(spark, root, name).count() == 20_000
    one = spark.createDataFrame([("u5",), ("nobody",)], "user_id string")
    assert [r.user_id for r in tables.read_gold(spark, root, name, users=one).collect()] == ["u5"]
