"""Daily states, the feed of changed days and gold refreshed by it."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from vitals.operators import daily_rollup, daily_states, merged_states, state_rollup, suppress_overlaps
from vitals.plans import gold, pipeline, refresh
from vitals.plans.pipeline import Lake, refresh_changed
from vitals.schema import GOLD_SCHEMAS, RECORD_SCHEMA, WORKOUT_SCHEMA
from vitals.sources import feed as feeds, tables

def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")


METRICS = ("step_count", "active_energy", "distance", "flights_climbed", "heart_rate", "sleep", "stand_hour", "hrv", "respiratory_rate", "body_mass")
SOURCES = ("Apple Watch", "Zepp", "iPhone", "other")


def made(seed, n, users=4, days=12, first=0):
    """Rows of a few users, some of them days long, whole values."""
    rng, out = random.Random(seed), []
    for i in range(n):
        start = dt.datetime(2024, 1, 1) + dt.timedelta(days=first + rng.randrange(days), minutes=rng.randrange(1440))
        length = rng.choice((0, 1, 30, 300, 1500, 4000))
        end = None if rng.random() < 0.03 else start + dt.timedelta(minutes=length)
        out.append((f"u{rng.randrange(users)}", rng.choice(SOURCES), "", "", "", None, start, end, float(rng.randrange(6)), rng.choice(METRICS),
                    dt.datetime(2024, 6, 1), "f", start.date()))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, RECORD_SCHEMA)


def shown(rows):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in rows.collect())


def test_states_of_two_batches_merge_to_one(spark):
    rows = list({r[:12]: r for r in made(1, 600)}.values())
    one = daily_states(frame(spark, rows))
    two = merged_states(daily_states(frame(spark, rows[::2])).unionByName(daily_states(frame(spark, rows[1::2]))))
    tidy = lambda s: shown(s.withColumn("zero_starts", F.array_sort("zero_starts")))
    assert tidy(one) == tidy(two)


@pytest.mark.parametrize("measures", [gold.HEART_RATE, gold.CARDIOVASCULAR, gold.RESPIRATORY])
def test_rollup_of_states(spark, measures):
    records = frame(spark, made(2, 500))
    want = daily_rollup(records, measures)
    assert shown(state_rollup(daily_states(records), measures).select(want.columns)) == shown(want)


def test_rollup_of_states_counts_distinct_starts(spark):
    records = frame(spark, made(3, 800))
    measures = [
        gold.Measure("stand_hours", "stand_hour", "count_distinct", value="start_date", only=F.col("value") == 0.0, default=0, cast="int"),
        gold.Measure("body_mass_kg", "body_mass", "avg"), gold.Measure("total", "body_mass", "sum")]
    want = daily_rollup(records, measures)
    assert shown(state_rollup(daily_states(records), measures).select(want.columns)) == shown(want)


@pytest.mark.parametrize("seed", range(3))
def test_overlaps_with_carried_reach(spark, seed):
    """Each day suppressed by itself, from its rows, those it reaches into and the reach of the others."""
    records = frame(spark, [r for r in made(10 + seed, 500) if r[9] in gold.MOVEMENT]).withColumn("row_id", F.monotonically_increasing_id()).cache()
    states, want = daily_states(records), shown(suppress_overlaps(records).select("row_id"))
    got = []
    for day in range(12):
        date = F.lit(dt.date(2024, 1, 1) + dt.timedelta(days=day))
        days = records.select("user_id").distinct().select("user_id", date.alias("date"))
        read, others = refresh.read_and_carried(states, days)
        part = records.join(read, ["user_id", "type", "date"], "left_semi")
        got += shown(suppress_overlaps(part, earlier=others).where(F.col("date") == date).select("row_id"))
    assert sorted(got) == want


def stored_gold(spark, lake):
    return {t: shown(tables.read_gold(spark, lake.gold, t).drop("updated_at")) for t in GOLD_SCHEMAS}


def full_gold(spark, lake, tmp_path):
    other = Lake(str(tmp_path / "full"), gold_buckets=2)
    for table, rows in gold.build_gold(tables.read_silver(spark, lake.records), tables.read_silver_workouts(spark, lake.workouts)).items():
        tables.upsert_gold(spark, rows, other.gold, table, now(), 2)
    return stored_gold(spark, other)


def workouts(spark, days):
    rows = [("u1", "Run", 30.0 + d, "min", 5.0, "km", 300.0, "kcal", "s", "", dt.datetime(2024, 1, d, 7), dt.datetime(2024, 1, d, 8),
             dt.datetime(2024, 6, 1), "f", dt.date(2024, 1, d)) for d in days]
    return spark.createDataFrame(rows, WORKOUT_SCHEMA)


def merge(spark, lake, rows, days=()):
    tables.merge_records(spark, frame(spark, rows), lake.records, 2, feed=lake.record_feed(spark))
    if days:
        tables.merge_workouts(spark, workouts(spark, days), lake.workouts, 2, feed=lake.workout_feed(spark))


def test_refresh_of_changed_days_equals_a_full_build(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), record_buckets=2, gold_buckets=2)
    first = made(5, 700)
    merge(spark, lake, first, (1, 2))
    assert refresh_changed(spark, lake, now()) == 2
    # One day of one user, with rows that reach over others' days, and copies of the old ones.
    late = [r for r in made(6, 40, users=1, days=1, first=5)]
    merge(spark, lake, first[:200] + late, (2, 3))
    changed = lake.record_feed(spark).changes(lake.record_feed(spark).runs())
    assert {(r.user_id, str(r.date)) for r in changed.collect()} == {("u0", "2024-01-06")}
    assert refresh_changed(spark, lake, now()) == 2 and refresh_changed(spark, lake, now()) == 0
    want, got = full_gold(spark, lake, tmp_path), stored_gold(spark, lake)
    # A day that has lost all its rows keeps its old one, in a full refresh by upsert too.
    for table in got:
        assert set(want[table]) <= set(got[table])
        assert len(got[table]) - len(want[table]) <= 2
    assert all(got.values())


def test_refresh_reads_the_changed_days_only(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), record_buckets=2, gold_buckets=2)
    merge(spark, lake, made(7, 800, days=40))
    refresh_changed(spark, lake, now())
    late = [(*r[:7], r[6] + dt.timedelta(minutes=5), *r[8:]) for r in made(8, 20, users=1, days=1, first=20)]
    merge(spark, lake, late)
    feed = lake.record_feed(spark)
    changes, states = feed.changes(feed.runs()), feed.states()
    moving = states.where(F.col("type").isin(*gold.MOVEMENT))
    days = refresh.touched_days(moving, changes.where(F.col("type").isin(*gold.MOVEMENT))).select("user_id", "date").distinct()
    read, _ = refresh.read_and_carried(moving, days)
    far = [r for r in read.collect() if abs((r.date - dt.date(2024, 1, 21)).days) > 6 or r.user_id != "u0"]
    assert read.count() > 0 and not far


@pytest.mark.parametrize("step", ["mark", "changes", "added", "states"])
def test_a_broken_merge_is_finished_by_the_next(spark, tmp_path, monkeypatch, step):
    lake = Lake(str(tmp_path / "lake"), record_buckets=2, gold_buckets=2)
    merge(spark, lake, made(20, 150))
    feed, rows = feeds.Feed, made(21, 150)

    def broken(*_, **__):
        raise RuntimeError("broken off")

    with monkeypatch.context() as patch:
        if step == "mark":
            patch.setattr(feed, "_finish", broken)
        elif step == "changes":
            patch.setattr(tables, "_write_partitioned", broken)
        elif step == "added":
            patch.setattr(feeds, "daily_states", broken)
        else:
            patch.setattr(feed, "clear", broken)
            append = feeds.VersionedTable.append
            patch.setattr(feeds.VersionedTable, "append", lambda *a: (append(*a), broken()))
        with pytest.raises(RuntimeError):
            merge(spark, lake, rows)
    merge(spark, lake, made(22, 50))
    stored = tables.read_silver(spark, lake.records)
    assert stored.count() == len({(r[0], r[9], r[1], r[6], r[7], r[8]) for r in made(20, 150) + rows + made(22, 50)})
    tidy = lambda s: shown(s.withColumn("zero_starts", F.array_sort("zero_starts")))
    assert tidy(lake.record_feed(spark).states()) == tidy(daily_states(stored))
    assert len(lake.record_feed(spark).runs()) == 3


@pytest.mark.parametrize("seed", range(2))
def test_days_to_read_are_those_of_both_steps_in_one_shuffle(spark, seed):
    rows = made(40 + seed, 500)
    one, two = frame(spark, rows[::2]), frame(spark, rows[1::2])
    parts = daily_states(one).unionByName(daily_states(two)).where(F.col("type").isin(*gold.MOVEMENT)).localCheckpoint()
    changes = frame(spark, made(50 + seed, 6, users=2)).select("user_id", "type", "date").distinct().localCheckpoint()
    moved = changes.where(F.col("type").isin(*gold.MOVEMENT))
    got = refresh.days_to_read(parts, changes)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    states = merged_states(parts)
    days = refresh.touched_days(states, moved).select("user_id", "date").unionByName(changes.select("user_id", "date")).distinct()
    read, others = refresh.read_and_carried(states, days)
    assert shown(got.where("_read").select(read.columns)) == shown(read) and read.count()
    assert shown(got.where("NOT _read").select("user_id", "type", "date")) == shown(others.select("user_id", "type", "_day"))
    assert shown(got.where("_wanted").select("user_id", "date").distinct()) == shown(days.join(states, ["user_id", "date"], "left_semi"))


def test_a_refresh_does_not_join_stored_records_with_users(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"), record_buckets=2, gold_buckets=2)
    merge(spark, lake, made(60, 200))
    seen, build = [], pipeline.changed_gold
    monkeypatch.setattr(pipeline, "changed_gold", lambda records, *more: seen.append(records) or build(records, *more))
    refresh_changed(spark, lake, now())
    assert "Join" not in seen[0]._jdf.queryExecution().analyzed().toString()
    assert not [name for _, _, names in os.walk(lake.staging) for name in names]
