"""Silver and gold tables as Parquet folders.

Silver is laid out by metric and user bucket, not by day: an export holds a
user's whole history, so loading one touches all days of few users. Rows inside
a file are sorted by user and time, which lets row-group statistics skip users
and dates.
"""

import posixpath
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..operators import keep_first
from ..schema import (
    GOLD_KEYS,
    GOLD_SCHEMAS,
    GOLD_TEXT_LIMITS,
    RECORD_KEYS,
    RECORD_SCHEMA,
    WORKOUT_KEYS,
    WORKOUT_SCHEMA,
)
from ..session import drop_shuffles
from .feed import Feed
from .keyfilter import KeyFilter, in_partitions
from .versions import Conflict, VersionedTable

BUCKET = T.StructField("user_bucket", T.IntegerType())
RECORD_PARTITIONS = ("records_type", "user_bucket")
WORKOUT_PARTITIONS = ("user_bucket",)

STORED_RECORDS = T.StructType(RECORD_SCHEMA.fields + [T.StructField("records_type", T.StringType()), BUCKET])
STORED_WORKOUTS = T.StructType(WORKOUT_SCHEMA.fields + [BUCKET])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; one metadata call, nothing is listed."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder this library made, if it is there."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def user_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")


def bucket_count(spark: SparkSession, path: str, buckets: int = 64) -> int:
    """Number of buckets the table was created with; ``buckets`` for a new one.

    Rows of a user are looked up by bucket, so the number is fixed for the
    table's life and kept beside it.
    """
    note = posixpath.join(path, "_layout")
    if exists(spark, posixpath.join(note, "_SUCCESS")):
        return spark.read.schema("buckets int").json(note).first()["buckets"]
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").json(note)
    return buckets


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_silver(
    spark: SparkSession, path: str, types: list[str] | None = None, users: DataFrame | None = None, exact: bool = True
) -> DataFrame:
    """Records of some metrics and users, all by default; both prune partitions (``exact`` as in ``of_users``)."""
    records = of_users(spark, path, _read(spark, path, STORED_RECORDS), users, exact=exact)
    return records if types is None else records.where(F.col("records_type").isin(*types))


def read_silver_workouts(spark: SparkSession, path: str, users: DataFrame | None = None, exact: bool = True) -> DataFrame:
    return of_users(spark, path, _read(spark, path, STORED_WORKOUTS), users, exact=exact)


def of_users(
    spark: SparkSession, path: str, rows: DataFrame, users: DataFrame | None, buckets: int | None = None, exact: bool = True
) -> DataFrame:
    """Stored rows of the users listed in ``users.user_id``.

    Only the users' buckets are read; at most one number per bucket is
    collected for that. A list kept as a table has a known size, by which Spark
    decides whether to broadcast it (see ``pipeline.listed_users``). Without
    ``exact`` other users of the same buckets come along, for callers that join
    the rows with narrower keys anyway and need not shuffle them for this, too.
    """
    if users is None or not exists(spark, path):
        return rows
    users = users.select("user_id")
    found = users.select(user_bucket(buckets or bucket_count(spark, path)).alias("bucket")).distinct().collect()
    rows = rows.where(F.col("user_bucket").isin([r.bucket for r in found]))
    return rows.join(users, "user_id", "left_semi") if exact else rows


def _write_partitioned(df: DataFrame, path: str, partitions, sort, mode: str, **options) -> None:
    """Rebalancing joins small partitions and splits large ones by size, so a
    bucket with a big user is written by several tasks."""
    (
        df.hint("rebalance", *[F.col(p) for p in partitions])
        .sortWithinPartitions(*partitions, *sort)
        .write.mode(mode).options(compression="zstd", **options)
        .partitionBy(*partitions)
        .parquet(path)
    )


def merge_records(
    spark: SparkSession, new: DataFrame, path: str, buckets: int = 64, written: bool = False, feed: Feed | None = None,
    filtered: bool = False,
) -> None:
    """Add records that are not stored yet. ``written`` says that ``new`` is read
    from a table, so that reading it several times is cheap. A ``feed`` learns
    the days of the rows added and keeps their states. A table once merged into
    ``filtered`` keeps filters of its keys (see ``keyfilter``): new keys are then
    added without reading stored rows."""
    placed = new.withColumn("records_type", F.col("type"))
    _merge(spark, placed, path, STORED_RECORDS, RECORD_KEYS, RECORD_PARTITIONS, buckets, written, feed, filtered)


def merge_workouts(
    spark: SparkSession, new: DataFrame, path: str, buckets: int = 64, written: bool = False, feed: Feed | None = None,
    filtered: bool = False,
) -> None:
    """Add workouts that are not stored yet; to a ``feed`` their metric is ``workout``; ``filtered`` as for records."""
    _merge(spark, new, path, STORED_WORKOUTS, WORKOUT_KEYS, WORKOUT_PARTITIONS, buckets, written, feed, filtered)


def _merge(spark, new, path, schema, keys, partitions, buckets, written, feed=None, filtered=False) -> None:
    """Keep-first merge by key, earliest ``ingested_at`` wins.

    Stored rows are earlier than the batch, so the merge is an append of the
    keys not stored: nothing stored is rewritten, and repeating a batch adds
    nothing. Only partitions the batch has rows in are read, and of them only
    the key columns. If part of the table was ingested after the batch, its
    copies may lose; then the touched partitions are replaced instead.

    An export repeats a user's whole history, so rows already stored are taken
    out first and copies within the batch looked for in what is left.
    """
    buckets = bucket_count(spark, path, buckets)
    finish_pending(spark, path, schema, partitions, ("user_id", "start_date"))
    if feed:
        feed.finish(schema, _adder(spark, path, schema, keys, partitions))
    batch = new.withColumn("user_bucket", user_bucket(buckets)).to(schema)
    if not written:
        staged = _own_folder(path, "_batch")
        batch.write.option("compression", "zstd").parquet(staged)
        batch = spark.read.schema(schema).parquet(staged)
    filters = KeyFilter(spark, path, schema, keys, partitions)
    if filtered or filters.exists():  # a table that has filters keeps them
        _merge_filtered(spark, batch, path, schema, keys, partitions, feed, filters)
    else:
        _merge_batch(spark, batch, path, schema, keys, partitions, feed)
    if not written:
        remove(spark, staged)


def _own_folder(path: str, purpose: str) -> str:
    """A folder of this run beside the table, so that two writers never share one."""
    return posixpath.join(path, purpose, f"run={uuid.uuid4().hex}")


def _adder(spark, path, schema, keys, partitions):
    """Appends rows of a merge that broke off, unless it had come to that."""
    def add(rows):
        touched = rows.select(*partitions).distinct().collect()  # as in a merge
        if touched:
            stored = _read(spark, path, schema).where(in_partitions(touched, partitions))
            _write_partitioned(_anti_null_safe(rows, stored, keys), path, partitions, ("user_id", "start_date"), "append")

    return add


def _merge_filtered(spark, batch, path, schema, keys, partitions, feed, filters) -> None:
    """As ``_merge_batch``, but only rows whose key may be stored are compared with the stored ones.

    Filters learn the batch's keys before anything is stored. If none of its
    keys is known, which is so for a batch of new readings but for some false
    alarms, no stored row is read: neither for keys, nor for who came earlier,
    which matters only to equal keys.
    """
    touched = batch.select(*partitions).distinct().collect()  # as in a merge
    if not touched:
        return
    filters.prepare(batch, _read(spark, path, schema), touched)
    staged = _own_folder(path, "_batch")
    filters.marked(batch, touched).write.partitionBy("known").parquet(staged)
    marked = spark.read.schema(T.StructType([*schema.fields, T.StructField("known", T.BooleanType())])).parquet(staged)
    filters.add(batch, touched)
    new, known = marked.where("NOT known").drop("known"), marked.where("known").drop("known")
    if known.isEmpty():
        fresh = keep_first(new, keys, ("ingested_at",))
        append = lambda rows: _write_partitioned(rows, path, partitions, ("user_id", "start_date"), "append")
        feed.apply(fresh, append) if feed else append(fresh)
    else:
        _merge_batch(spark, known, path, schema, keys, partitions, feed, new)
    remove(spark, staged)


def _merge_batch(spark, batch, path, schema, keys, partitions, feed=None, new=None) -> None:
    """``new`` are further rows that are not stored for certain."""
    # At most (number of metrics) x (number of buckets) rows.
    touched = batch.groupBy(*partitions).agg(F.min("ingested_at").alias("earliest")).collect()
    if not touched:
        return
    earliest = min(row["earliest"] for row in touched)
    stored = spark.read.schema(schema).parquet(path).where(in_partitions(touched, partitions))
    if stored.where(F.col("ingested_at") > F.lit(earliest)).isEmpty():
        # Only stored rows of the batch's users can be the same.
        stored = stored.join(batch.select("user_id").distinct(), "user_id", "left_semi")
        fresh = _anti_null_safe(batch, stored, keys)
        fresh = keep_first(fresh if new is None else fresh.unionByName(new), keys, ("ingested_at",))
        if feed:
            feed.apply(fresh, lambda rows: _write_partitioned(rows, path, partitions, ("user_id", "start_date"), "append"))
        else:
            _write_partitioned(fresh, path, partitions, ("user_id", "start_date"), "append")
    else:
        if new is not None:
            batch = batch.unionByName(new)
            touched = batch.select(*partitions).distinct().collect()
            stored = spark.read.schema(schema).parquet(path).where(in_partitions(touched, partitions))
        merged = keep_first(stored.unionByName(batch), keys, ("ingested_at",))
        if feed:
            # Rows that replace others have the same keys, so records' days are
            # changed by new keys only; other columns of workouts may change too.
            fresh = keep_first(_anti_null_safe(batch, stored, keys) if feed.with_states else batch, keys, ("ingested_at",))
            feed.apply(fresh, lambda _: replace_partitions(spark, merged, path, schema, partitions, ("user_id", "start_date")))
        else:
            replace_partitions(spark, merged, path, schema, partitions, ("user_id", "start_date"))


def _anti_null_safe(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; NULL equals NULL."""
    other = right.select(*[F.col(k).alias(f"_{k}") for k in keys])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return left.join(other, match, "left_anti")


def replace_partitions(spark, df, path, schema, partitions, sort) -> None:
    """Replace whole partitions by new contents, safely.

    The contents are first written whole beside the table, then a mark naming
    them, and only then are partitions swapped and the mark taken away. While a
    mark is there every writer finishes that swap before anything else, so a
    break at any point loses nothing and an old swap is never repeated.
    """
    finish_pending(spark, path, schema, partitions, sort)
    contents = _own_folder(path, "_replacement")
    _write_partitioned(df, contents, partitions, sort, "overwrite")
    mark = spark.createDataFrame([(contents,)], "contents string").coalesce(1)
    mark.write.mode("overwrite").json(posixpath.join(path, "_pending"))
    finish_pending(spark, path, schema, partitions, sort)


def finish_pending(spark, path, schema, partitions, sort) -> bool:
    """Repeat the marked swap, if there is one; says whether there was."""
    mark = posixpath.join(path, "_pending")
    if not exists(spark, posixpath.join(mark, "_SUCCESS")):
        return False
    contents = spark.read.schema("contents string").json(mark).first()["contents"]
    rows = spark.read.schema(schema).parquet(contents)
    _write_partitioned(rows, path, partitions, sort, "overwrite", partitionOverwriteMode="dynamic")
    remove(spark, mark)
    remove(spark, contents)
    return True


def finish_replacement(spark, path, schema, partitions, sort) -> None:
    """Finish a swap that broke off; without one it is an error, since repeating an old swap would lose newer rows."""
    if not finish_pending(spark, path, schema, partitions, sort):
        raise ValueError(f"no swap is pending at {path}")


def compact_records(spark: SparkSession, path: str, types: list[str] | None = None) -> None:
    """Rewrite the partitions of some metrics, or all, in few sorted files."""
    rows = read_silver(spark, path, types)
    replace_partitions(spark, rows, path, STORED_RECORDS, RECORD_PARTITIONS, ("user_id", "start_date"))


# ---------------------------------------------------------------- gold


def _stored_gold(table: str) -> T.StructType:
    return T.StructType(GOLD_SCHEMAS[table].fields + [BUCKET])


def gold_table(spark: SparkSession, root: str, table: str, buckets: int = 16) -> VersionedTable:
    """A gold table's versions; ``buckets`` counts only where the table is new."""
    return VersionedTable(
        spark, posixpath.join(root, table), _stored_gold(table), GOLD_KEYS[table], ("user_bucket",), buckets=buckets)


def read_gold(
    spark: SparkSession, root: str, table: str, users: DataFrame | None = None
) -> DataFrame:
    """One gold table; order is left to the reader."""
    stored = gold_table(spark, root, table)
    if not stored.exists():
        return spark.createDataFrame([], GOLD_SCHEMAS[table])
    return of_users(spark, stored.path, stored.read(), users, stored.state().options["buckets"]).drop("user_bucket")


def compact_gold(spark: SparkSession, root: str, table: str, least: int = 2) -> bool:
    """Merge a gold table's versions into one if there are ``least`` or more; False if not, or if another writer does it."""
    try:
        return gold_table(spark, root, table).compact(least=least) is not None
    except Conflict:
        return False


def refusal(incoming: DataFrame, keys: tuple[str, ...]) -> Column:
    """Why a gold row cannot be stored (NULL if it can): a missing key, text wider than the table declares, a repeated key."""
    why = F
    for key in keys:
        why = why.when(F.col(key).isNull(), F.lit(f"{key} is missing"))
    for name, width in GOLD_TEXT_LIMITS.items():
        if name in incoming.columns:
            why = why.when(F.length(name) > width, F.lit(f"{name} is longer than {width} characters"))
    order = [F.col(c).asc_nulls_last() for c in incoming.columns if c not in keys] or [F.lit(0)]
    # Rows without a key are refused anyway and must not meet in one task.
    apart = F.when(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]), F.xxhash64(*incoming.columns))
    return why.when(F.row_number().over(Window.partitionBy(*keys, apart).orderBy(*order)) > 1, F.lit("the key is there twice"))


def upsert_gold(
    spark: SparkSession, incoming: DataFrame, root: str, table: str, now: Column, buckets: int = 16,
    registered: DataFrame | None = None, rejected: str | None = None,
) -> None:
    """Insert or replace rows of a gold table by key.

    The batch becomes a version of the table (see ``versions``): it is written in
    bytes of its own size, nothing stored is read or rewritten, and writers
    beside each other lose nothing; of two that give the same key the later
    commit counts. An empty input changes nothing. Rows that break the table's
    contract are put aside once with the reason under ``rejected`` (by default
    beside ``root``) and do not hold up the others:
    a missing key, too wide a text, a key given twice (the first by its other
    columns is stored) and, with a table of ``registered`` users (column
    ``username``), a user not in it. Rows are computed once.
    """
    stored = gold_table(spark, root, table, buckets)
    path, schema, keys = stored.path, stored.schema, stored.keys
    marked = incoming.withColumn("refused", refusal(incoming, keys))
    if registered is not None:
        known = registered.select(F.col("username").alias("user_id")).distinct().withColumn("known", F.lit(True))
        marked = marked.join(known, "user_id", "left")
        marked = marked.withColumn("refused", F.coalesce("refused", F.when(F.col("known").isNull(), F.lit("the user is not known")))).drop("known")
    batch = marked.withColumn("updated_at", now.cast("timestamp_ntz"))
    batch = batch.withColumn("user_bucket", user_bucket(stored.state().options["buckets"])).to(T.StructType(schema.fields + [T.StructField("refused", T.StringType())]))
    staged = _own_folder(path, "_batch")
    batch.write.option("compression", "zstd").parquet(staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    refused = batch.where(F.col("refused").isNotNull()).drop("user_bucket")
    if not refused.isEmpty():
        aside = posixpath.join(rejected or f"{root.rstrip('/')}_rejected", table)
        before = _read(spark, aside, refused.schema)
        unseen = _anti_null_safe(refused, before, [c for c in refused.columns if c != "updated_at"])
        unseen.write.mode("append").parquet(aside)
    accepted = batch.where(F.col("refused").isNull()).drop("refused")
    if not accepted.isEmpty():
        drop_shuffles(spark)  # what computed the rows; storing them shuffles them again
        stored.append(accepted)
    remove(spark, staged)
