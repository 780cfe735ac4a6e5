"""Bronze, silver and gold stages over a folder of tables, all users at once."""

import posixpath
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..schema import GOLD_SCHEMAS, RECORD_SCHEMA, WORKOUT_SCHEMA
from ..session import drop_shuffles
from ..sources import archives, export_xml, tables
from ..sources.feed import Feed
from ..sources.versions import VersionedTable
from .gold import build_gold, workouts_summary
from .refresh import changed_gold

STAGES = ("bronze", "silver", "gold", "all")

# The user is the folder an archive lies in.
USER_FOLDER = r"([^/]+)/[^/]+\.zip$"


@dataclass(frozen=True)
class Lake:
    """Folders of one installation, on storage all executors reach.

    ``key_filters`` has silver keep filters of its keys, so that new readings
    are added without reading stored ones; once kept they stay.
    """

    root: str
    record_buckets: int = 64
    gold_buckets: int = 16
    key_filters: bool = False

    def _under(self, name: str) -> str:
        return posixpath.join(self.root, name)

    @property
    def bronze(self) -> str:
        return self._under("bronze")

    @property
    def staging(self) -> str:
        return self._under("staging")

    @property
    def records(self) -> str:
        return self._under("silver/records")

    @property
    def workouts(self) -> str:
        return self._under("silver/workouts")

    @property
    def quarantine(self) -> str:
        return self._under("silver/quarantine")

    @property
    def rejected(self) -> str:
        return self._under("gold_rejected")

    @property
    def loaded(self) -> str:
        return self._under("silver/loaded")

    @property
    def gold(self) -> str:
        return self._under("gold")

    def record_feed(self, spark: SparkSession) -> Feed:
        return Feed(spark, self._under("silver/feed/records"))

    def workout_feed(self, spark: SparkSession) -> Feed:
        return Feed(spark, self._under("silver/feed/workouts"), with_states=False)


def land(spark: SparkSession, lake: Lake, source: str, user_pattern: str = USER_FOLDER) -> DataFrame:
    """Bronze: keep every archive below ``source`` that is not kept yet."""
    found = archives.with_path_user(archives.list_archives(spark, source), user_pattern)
    with kept_listing(spark, lake, found) as listed:
        return land_listed(spark, lake, listed, user_pattern)


@contextmanager
def kept_listing(spark: SparkSession, lake: Lake, listed: DataFrame) -> Iterator[DataFrame]:
    """A file listing written as a table for the time being, so that files are listed once, not by every step.

    Spark gives a handful of small files a task; the listing is made in a few.
    """
    path = posixpath.join(lake.staging, "listed", f"run={uuid.uuid4().hex}")
    listed.coalesce(2 * spark.sparkContext.defaultParallelism).write.parquet(path)
    yield spark.read.schema(listed.schema).parquet(path)
    tables.remove(spark, path)


def land_listed(spark: SparkSession, lake: Lake, listed: DataFrame, user_pattern: str = USER_FOLDER) -> DataFrame:
    """Bronze for a given file listing (path, modificationTime, length).

    Archives without a safe user id are listed in quarantine and left out.
    """
    aside = archives.without_user(listed, user_pattern)
    if not aside.isEmpty():
        folder = posixpath.join(lake.quarantine, "paths")
        if tables.exists(spark, folder):  # each is listed once
            aside = aside.join(spark.read.schema(aside.schema).parquet(folder), aside.columns, "left_anti")
        aside.write.mode("append").parquet(folder)
    return archives.land_archives(spark, archives.with_user(listed, user_pattern), lake.bronze)


def pending(spark: SparkSession, lake: Lake, users: DataFrame | None = None) -> DataFrame:
    """Landed archives that silver has not taken in."""
    landed = archives.read_catalog(spark, lake.bronze)
    if users is not None:
        landed = landed.join(users.select("user_id"), "user_id", "left_semi")
    loaded = _loaded(spark, lake)
    if not loaded.exists():
        return landed
    return landed.join(loaded.read().where("taken").select("user_id", "sha256"), ["user_id", "sha256"], "left_anti")


def _loaded(spark: SparkSession, lake: Lake) -> VersionedTable:
    """Archives by user and content, and whether silver has taken them in."""
    schema = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("sha256", T.StringType()), T.StructField("taken", T.BooleanType())])
    return VersionedTable(spark, lake.loaded, schema, ("user_id", "sha256"))


def load_silver(
    spark: SparkSession, lake: Lake, landed: DataFrame, now: Column
) -> dict[str, int]:
    """Silver: unpack archives, type their elements, merge them into the tables.

    Returns how many elements were read. Rows and archives that cannot be used
    go to the quarantine folder and do not hold up the others. An archive counts
    as loaded only after both merges, and loading it again adds nothing.
    """
    run = uuid.uuid4().hex
    staged = posixpath.join(lake.staging, f"run={run}")
    unpacked = archives.unpack_exports(landed, staged, set_aside=True)
    if unpacked.isEmpty():
        tables.remove(spark, staged)
        return {"records": 0, "workouts": 0, "bad_archives": 0}
    # What the merges leave to be done does not need the documents.
    listed = posixpath.join(lake.staging, "unpacked", f"run={run}")
    named = unpacked.select("user_id", "sha256", F.col("error").isNotNull().alias("bad")).distinct()
    named.coalesce(2 * spark.sparkContext.defaultParallelism).write.option("compression", "zstd").parquet(listed)
    done = spark.read.schema(named.schema).parquet(listed)
    unpacked.where(F.col("error").isNotNull()).write.parquet(posixpath.join(lake.quarantine, "archives", f"run={run}"))

    def typed_at(kind):
        return posixpath.join(lake.staging, f"typed_{kind}", f"run={run}")

    def parse(kind, read, conform):
        counter = Observation(kind)
        file_source = F.concat(F.col("sha256"), F.lit(".zip"))
        typed = conform(read(spark, staged), now, file_source).observe(counter, F.count(F.lit(1)).alias("n"))
        # Parse once, then split the stored rows.
        typed.write.mode("overwrite").option("compression", "zstd").parquet(typed_at(kind))
        return kind, counter.get["n"]

    def load(kind, schema, merge, path, feed):
        good, bad = export_xml.readable(spark.read.schema(schema).parquet(typed_at(kind)))
        bad.write.mode("overwrite").parquet(posixpath.join(lake.quarantine, kind, f"run={run}"))
        merge(spark, good, path, lake.record_buckets, written=True, feed=feed, filtered=lake.key_filters)
        tables.remove(spark, typed_at(kind))  # all of it is in silver or quarantine now

    counts = dict(_together(spark, [
        lambda: parse("records", export_xml.read_record_elements, export_xml.conform_records),
        lambda: parse("workouts", export_xml.read_workout_elements, export_xml.conform_workouts),
    ]))
    tables.remove(spark, staged)  # every element is typed
    drop_shuffles(spark)
    _together(spark, [
        lambda: load("records", RECORD_SCHEMA, tables.merge_records, lake.records, lake.record_feed(spark)),
        lambda: load("workouts", WORKOUT_SCHEMA, tables.merge_workouts, lake.workouts, lake.workout_feed(spark)),
    ])
    counts["bad_archives"] = done.where("bad").count()
    _loaded(spark, lake).append(done.select("user_id", "sha256", F.lit(True).alias("taken")))
    tables.remove(spark, listed)
    return counts


def retry_quarantined(spark: SparkSession, lake: Lake) -> int:
    """Have the next load try archives again that were set aside as bad; returns how many.

    They count as not loaded from then on and leave the quarantine list, which
    takes in again what is still bad. What loaded since was only held up by a
    passing fault and is not tried again.
    """
    aside = posixpath.join(lake.quarantine, "archives")
    loaded = _loaded(spark, lake)
    if not tables.exists(spark, aside) or not loaded.exists():
        return 0
    listed = spark.read.schema("user_id string, sha256 string, run string").option("basePath", aside).parquet(aside)
    runs = [row["run"] for row in listed.select("run").distinct().collect()]  # one name per load with bad archives
    bad = listed.select("user_id", "sha256").distinct()
    again = loaded.read().where("taken").join(bad, ["user_id", "sha256"], "left_semi").withColumn("taken", F.lit(False))
    count = again.count()
    if count:
        loaded.append(again)
    for run in runs:
        tables.remove(spark, posixpath.join(aside, f"run={run}"))
    return count


def _together(spark: SparkSession, calls: list[Callable]) -> list:
    """Runs independent table loads side by side, so that the short last stages
    of one do not leave the cluster idle. The first failure is raised."""
    with ThreadPoolExecutor(len(calls)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
        return [each.result() for each in running]


@contextmanager
def listed_users(spark: SparkSession, lake: Lake, users: DataFrame | None) -> Iterator[DataFrame | None]:
    """A list of users written as a table for the time being, so that its size is known to the planner.

    Otherwise Spark would guess the size from what the list was made of (whole
    archives, say) and shuffle every stored record to join it.
    """
    if users is None:
        yield None
        return
    path = posixpath.join(lake.staging, "users", f"run={uuid.uuid4().hex}")
    users.select("user_id").distinct().write.parquet(path)
    yield spark.read.schema("user_id string").parquet(path)
    tables.remove(spark, path)


def refresh_gold(
    spark: SparkSession,
    lake: Lake,
    now: Column,
    users: DataFrame | None = None,
    registered: DataFrame | None = None,
) -> None:
    """Gold: recompute the summaries of some users, or all, and upsert them.

    With a table of ``registered`` users (column ``username``) rows of anyone
    else are not stored but put aside under ``lake.rejected``, as are rows that
    break a table's contract (see ``tables.upsert_gold``).
    """
    def store(table, rows):
        tables.upsert_gold(spark, rows, lake.gold, table, now, lake.gold_buckets, registered, lake.rejected)

    drop_shuffles(spark)
    with listed_users(spark, lake, users) as listed:
        records = tables.read_silver(spark, lake.records, users=listed)
        workouts = tables.read_silver_workouts(spark, lake.workouts, users=listed)
        built = build_gold(records, workouts)
        _together(spark, [lambda table=table, rows=rows: store(table, rows) for table, rows in built.items()])
    compact_gold(spark, lake)


def refresh_changed(
    spark: SparkSession, lake: Lake, now: Column, registered: DataFrame | None = None
) -> int:
    """Gold: recompute the days that merges have changed since the last such refresh; returns of how many merges.

    Costs by the changed days, not by the users' histories (see ``refresh``).
    Merges are taken off the list only after all tables are stored, so a break
    repeats them, to the same rows.
    """
    records_feed, workouts_feed = lake.record_feed(spark), lake.workout_feed(spark)
    runs, workout_runs = records_feed.runs(), workouts_feed.runs()
    kept = posixpath.join(lake.staging, "changes", f"run={uuid.uuid4().hex}")

    def keep(rows: DataFrame, name: str) -> DataFrame:
        rows.write.option("compression", "zstd").parquet(posixpath.join(kept, name))
        return spark.read.schema(rows.schema).parquet(posixpath.join(kept, name))

    changes = keep(records_feed.changes(runs).unionByName(workouts_feed.changes(workout_runs)), "changes")
    users = changes.select("user_id")
    bounds = changes.agg(F.min("date").alias("low"), F.max("date").alias("high")).first()
    if bounds["low"] is not None:
        kinds = {row["type"] for row in changes.select("type").distinct().collect()}  # at most one per metric
        records = tables.read_silver(spark, lake.records, users=users, exact=False)
        built = changed_gold(records, records_feed.state_parts(), changes.where("type <> 'workout'"), kinds, keep)
        if "workout" in kinds:
            days = changes.where("type = 'workout'").select("user_id", "date").distinct()
            workouts = tables.read_silver_workouts(spark, lake.workouts, users=users, exact=False).where(
                F.col("date").between(F.lit(bounds["low"]), F.lit(bounds["high"])))
            built["workouts_summary"] = workouts_summary(workouts.join(days, ["user_id", "date"], "left_semi"))
        _together(spark, [
            lambda table=table, rows=rows: tables.upsert_gold(spark, rows, lake.gold, table, now, lake.gold_buckets, registered, lake.rejected)
            for table, rows in built.items()])
        compact_gold(spark, lake)
        records_feed.compact(VERSIONS)
    records_feed.clear(runs)
    workouts_feed.clear(workout_runs)
    tables.remove(spark, kept)
    return len(runs) + len(workout_runs)


#: Versions of a table that readers merge before they are compacted.
VERSIONS = 16


def compact_gold(spark: SparkSession, lake: Lake, least: int = VERSIONS) -> None:
    """Merge the versions of each gold table that has ``least`` or more."""
    for table in GOLD_SCHEMAS:
        tables.compact_gold(spark, lake.gold, table, least)


def run_pipeline(
    spark: SparkSession,
    lake: Lake,
    stage: str = "all",
    source: str | None = None,
    users: DataFrame | None = None,
    registered: DataFrame | None = None,
    user_pattern: str = USER_FOLDER,
    now: Column | None = None,
) -> dict[str, DataFrame]:
    """Run one stage or all three; returns the gold tables as stored.

    ``users`` (column ``user_id``) limits silver and gold; by default silver
    takes every archive not loaded yet and gold covers everyone. ``registered``
    limits whose rows gold accepts (see ``refresh_gold``).
    """
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}, not {stage!r}")
    now = F.current_timestamp() if now is None else now
    if stage in ("bronze", "all"):
        if source is None:
            raise ValueError("the bronze stage needs a source folder")
        land(spark, lake, source, user_pattern)
    if stage in ("silver", "all"):
        load_silver(spark, lake, pending(spark, lake, users), now)
    if stage in ("gold", "all"):
        refresh_gold(spark, lake, now, users, registered)
    return {table: tables.read_gold(spark, lake.gold, table) for table in GOLD_SCHEMAS}
