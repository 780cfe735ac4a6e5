"""Overlap suppression against a row-by-row check."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vitals.operators import suppress_overlaps

SCHEMA = "id int, user_id string, type string, source_name string, start_date timestamp_ntz, end_date timestamp_ntz, value double"
NAMES = ["My Watch", "Zepp", "Phone", "Other", None]


def rank(name):
    if name and "Watch" in name:
        return 1
    return 2 if name == "Zepp" else 3


def survivors(rows):
    kept = set()
    for a in rows:
        hit = any(
            b[1] == a[1] and b[2] == a[2] and b[1] is not None and rank(b[3]) < rank(a[3])
            and None not in (a[4], a[5], b[4], b[5]) and b[4] < a[5] and a[4] < b[5]
            for b in rows
        )
        if not hit:
            kept.add(a[0])
    return kept


def random_rows(seed, n=300, days=3, step=600):
    rng = random.Random(seed)
    base = dt.datetime(2024, 3, 1)
    rows = []
    for i in range(n):
        start = base + dt.timedelta(seconds=step * rng.randrange(days * 86400 // step))
        length = rng.choice([0, 0, 600, 600, 1200, 3600, 7200, 90000, 260000, -600, -90000])
        end = start + dt.timedelta(seconds=length)
        if rng.random() < 0.03:
            start = None
        if rng.random() < 0.03:
            end = None
        rows.append((i, rng.choice(["a", "b", None]), rng.choice(["x", "y"]), rng.choice(NAMES), start, end, 1.0))
    return rows


@pytest.mark.parametrize("seed", range(5))
def test_equals_pairwise_check(spark, seed):
    rows = random_rows(seed)
    kept = suppress_overlaps(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.id for r in kept) == sorted(survivors(rows))


def test_edges(spark):
    def at(hour, minute=0):
        return dt.datetime(2024, 1, 1, hour, minute)

    rows = [
        (1, "u", "x", "Watch", at(8), at(9), 1.0),
        (2, "u", "x", "Phone", at(9), at(10), 1.0),       # touches 1, but meets 6
        (3, "u", "x", "Phone", at(7), at(8), 1.0),        # touches at the end
        (4, "u", "x", "Phone", at(8, 30), at(8, 30), 1.0),  # empty, inside
        (5, "u", "x", "Phone", at(8), at(8), 1.0),        # empty, at the edge
        (6, "u", "x", "Zepp", at(8, 59), at(11), 1.0),    # dropped by 1
        (7, "u", "x", "Phone", at(10, 30), at(12), 1.0),  # dropped by the dropped 6
        (8, "v", "x", "Phone", at(8), at(9), 1.0),        # other user
        (9, "u", "y", "Phone", at(8), at(9), 1.0),        # other metric
        (10, "u", "x", "Phone", at(7), at(8), 1.0),       # copies are kept as
        (10, "u", "x", "Phone", at(7), at(8), 1.0),       # often as they occur
    ]
    kept = suppress_overlaps(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.id for r in kept) == [1, 3, 5, 8, 9, 10, 10]


def test_long_interval_reaches_over_days(spark):
    rows = [
        (1, "u", "x", "Watch", dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), 1.0),
        (2, "u", "x", "Phone", dt.datetime(2024, 1, 20, 5), dt.datetime(2024, 1, 20, 6), 1.0),
        (3, "u", "x", "Phone", dt.datetime(2024, 2, 3, 5), dt.datetime(2024, 2, 3, 6), 1.0),
    ]
    kept = suppress_overlaps(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.id for r in kept) == [1, 3]


def test_other_ranking(spark):
    rows = random_rows(99)
    ranking = ("Phone", "Other", "%Watch%")
    order = {"Phone": 1, "Other": 2, "My Watch": 3}
    kept = suppress_overlaps(spark.createDataFrame(rows, SCHEMA), ranking=ranking).collect()
    want = {
        a[0] for a in rows if not any(
            b[1] == a[1] and b[2] == a[2] and b[1] is not None
            and order.get(b[3], 4) < order.get(a[3], 4)
            and None not in (a[4], a[5], b[4], b[5]) and b[4] < a[5] and a[4] < b[5] for b in rows)
    }
    assert sorted(r.id for r in kept) == sorted(want)


def test_copies_stay_copies_and_do_not_blow_up(spark):
    """A hot key with masses of copies: still one point per time."""
    hot = spark.range(200_000).select(
        F.col("id").cast("int").alias("id"), F.lit("hot").alias("user_id"), F.lit("x").alias("type"),
        F.lit("Phone").alias("source_name"),
        F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("start_date"),
        F.lit("2024-01-01 11:00:00").cast("timestamp_ntz").alias("end_date"),
        F.lit(1.0).alias("value"),
    )
    assert suppress_overlaps(hot).count() == 200_000
    watch = hot.limit(1).withColumn("source_name", F.lit("Watch"))
    assert suppress_overlaps(hot.unionByName(watch)).count() == 1


def test_plan_has_no_pairwise_join(spark):
    rows = spark.createDataFrame(random_rows(1), SCHEMA)
    plan = suppress_overlaps(rows)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_windows_are_cut_by_day(spark):
    """No step gathers the rows of one (user, metric) in one task."""
    rows = spark.createDataFrame(random_rows(1), SCHEMA)
    plan = suppress_overlaps(rows)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    by_key_only = [e for e in exchanges if "_day" not in e and "end_date" not in e]
    # The one exchange by key alone carries a row per day, already aggregated.
    assert len(by_key_only) == 1
    after = plan[plan.index("hashpartitioning(" + by_key_only[0]):].splitlines()
    assert "HashAggregate(keys=[user_id" in after[1] and "_day" in after[1] and "_at" not in after[1].split("]")[0]
