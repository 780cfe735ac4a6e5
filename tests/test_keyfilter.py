"""Filters of stored keys: exact merges that read no stored rows for new keys."""

import pytest
from pyspark.sql import functions as F

from tests.test_storage import record_rows, stamp, stored
from vitals.schema import RECORD_KEYS
from vitals.sources import keyfilter, tables
from vitals.sources.keyfilter import KeyFilter


def filters(spark, path):
    return KeyFilter(spark, path, tables.STORED_RECORDS, RECORD_KEYS, tables.RECORD_PARTITIONS)


def spoil(tmp_path):
    """Overwrites the stored files so that reading one fails; returns how to undo it."""
    files = {f: f.read_bytes() for f in tmp_path.glob("records/records_type=*/*/*.parquet")}
    for f in files:
        f.write_bytes(b"no table")
    assert files
    return lambda: [f.write_bytes(content) for f, content in files.items()]


def test_new_keys_are_added_without_reading_stored_rows(spark, tmp_path):
    path = str(tmp_path / "records")
    first = [(u, "hrv", m, 1.0, "1") for u in "abc" for m in range(12)]
    tables.merge_records(spark, record_rows(spark, first, 2), path, buckets=2, filtered=True)
    undo = spoil(tmp_path)
    new = [(u, k, m, 1.0, "1") for u in "abc" for m in range(40, 44) for k in ("hrv", "sleep")]
    tables.merge_records(spark, record_rows(spark, new + new[:5], 1), path)  # filters stay; an earlier batch is no matter
    with pytest.raises(Exception, match="no table|not a Parquet|PARQUET|CANNOT_READ|FAILED_READ"):
        tables.merge_records(spark, record_rows(spark, first[:1], 3), path)  # here the stored row must be seen
    undo()
    tables.merge_records(spark, record_rows(spark, first + new + [("d", "hrv", 1, 2.0, "1")], 3), path)
    assert stored(spark, path) == sorted(first + new + [("d", "hrv", 1, 2.0, "1")])


def test_false_alarms_and_earlier_copies_are_exact(spark, tmp_path, monkeypatch):
    """With every key known the merge is the plain one, also where an earlier export arrives late."""
    monkeypatch.setattr(KeyFilter, "marked", lambda self, batch, touched: batch.withColumn("known", F.col("value") < 50))
    path, plain = str(tmp_path / "records"), str(tmp_path / "plain")
    batches = [
        ([("a", "hrv", m, float(m), "1") for m in range(30)], 4),
        ([("a", "hrv", m, float(m), "2") for m in range(20, 70)], 5),
        ([("a", "hrv", m, float(m), "0") for m in range(10, 40)] + [("b", "sleep", 1, 90.0, "0")], 1),
    ]
    for rows, day in batches:
        tables.merge_records(spark, record_rows(spark, rows, day), path, buckets=2, filtered=True)
        tables.merge_records(spark, record_rows(spark, rows, day), plain, buckets=2)
    assert stored(spark, path) == stored(spark, plain) and len(stored(spark, path)) == 71


def test_odd_keys_are_known_and_others_mostly_not(spark, tmp_path):
    path = str(tmp_path / "records")
    rows = record_rows(spark, [("a", "hrv", m, v, "1") for m in range(40) for v in (None, float("nan"), -0.0, 2.5)], 1)
    rows = rows.withColumn("end_date", F.when(F.col("value") == 2.5, None).otherwise(F.col("end_date")))
    tables.merge_records(spark, rows, path, buckets=1, filtered=True)
    again = rows.withColumn("value", F.when(F.col("value") == 0, F.lit(0.0)).otherwise(F.col("value"))).withColumn("ingested_at", stamp(9))
    tables.merge_records(spark, again, path)
    assert len(tables.read_silver(spark, path).collect()) == 160
    placed = lambda df: df.withColumn("records_type", F.col("type")).withColumn("user_bucket", F.lit(0))
    touched = [("hrv", 0)]
    assert filters(spark, path).marked(placed(again), touched).where("known").count() == 160
    others = record_rows(spark, [("a", "hrv", m, 1.0, "1") for m in range(1000, 3000)], 1)
    assert filters(spark, path).marked(placed(others), touched).where("known").count() < 200
    assert filters(spark, path).marked(placed(others).limit(0), touched).count() == 0


def test_filters_grow_with_the_table_and_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyfilter, "COMPACT_FROM", 4)
    path = str(tmp_path / "records")
    every = []
    for step, size in enumerate((5, 40, 400, 3000)):
        rows = [("a", "hrv", 10_000 * step + m, 1.0, "1") for m in range(size)]
        every += rows
        tables.merge_records(spark, record_rows(spark, rows, step + 1), path, buckets=1, filtered=True)
    words = filters(spark, path)
    assert len(words.table.state().live) < 8
    placed = lambda rows: record_rows(spark, rows, 1).withColumn("records_type", F.col("type")).withColumn("user_bucket", F.lit(0))
    assert words.marked(placed(every), [("hrv", 0)]).where("NOT known").count() == 0
    others = [("b", "hrv", m, 1.0, "1") for m in range(2000)]
    assert words.marked(placed(others), [("hrv", 0)]).where("known").count() < 100
    assert len(stored(spark, path)) == len(every)


def test_a_table_without_filters_gets_them(spark, tmp_path):
    """Filters are built from what is stored; a break after the keys are learnt loses no row."""
    path = str(tmp_path / "records")
    old = [("a", "hrv", m, 1.0, "1") for m in range(20)]
    tables.merge_records(spark, record_rows(spark, old, 1), path, buckets=2)
    tables.merge_records(spark, record_rows(spark, old, 2), path, filtered=True)
    assert stored(spark, path) == old and filters(spark, path).exists()
    new = record_rows(spark, [("a", "hrv", 50, 1.0, "1")], 3).withColumn("records_type", F.col("type"))
    placed = new.withColumn("user_bucket", tables.user_bucket(2)).to(tables.STORED_RECORDS)
    touched = placed.select("records_type", "user_bucket").distinct().collect()
    filters(spark, path).add(placed, touched)  # as if the merge broke here
    tables.merge_records(spark, new.drop("records_type"), path)
    assert stored(spark, path) == old + [("a", "hrv", 50, 1.0, "1")]
    tables.merge_records(spark, new.drop("records_type").limit(0), path)
    assert len(stored(spark, path)) == 21
