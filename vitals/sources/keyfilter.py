"""Which keys a table may hold: Bloom filters per partition, kept beside the table.

A key sets four bits in one 64-bit word of its partition's filter; the first
``level`` bits of its hash number the word. So adding keys is a grouped OR, and
looking them up is one join by partition and word, both on Spark, and nobody
holds a filter whole. A partition whose words fill up, or that has none yet, is
built anew from its stored keys with four times the words its keys need, so the
reading this takes is in proportion to the table over its life.

A filter knows every stored key, as keys are added before their rows: after a
break it may know too many. A key it does not know is not stored; one it knows
may be, and the table itself must be asked. One writer at a time.
"""

import posixpath
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .versions import VersionedTable

KEYS_PER_WORD = 4
BITS = 4
FULL = 0.4
LEAST_LEVEL, MOST_LEVEL = 4, 48
COMPACT_FROM = 16


class KeyFilter:
    """Filters of the table at ``path`` by its ``keys``, one per value of ``partitions``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: tuple[str, ...], partitions: tuple[str, ...]):
        self.spark, self.keys, self.partitions, self.schema = spark, tuple(keys), tuple(partitions), schema
        self.words = T.StructType([schema[p] for p in partitions] + [
            T.StructField("level", T.IntegerType()), T.StructField("word", T.LongType()), T.StructField("bits", T.LongType())])
        self.table = VersionedTable(spark, posixpath.join(path, "_keys"), self.words, (*partitions, "level", "word"), self.partitions)

    def exists(self) -> bool:
        return self.table.exists()

    # ------------------------------------------------------------ keys as bits

    def _hashes(self, seed: int) -> Column:
        """NULLs are passed over and -0.0 counts as 0.0, so keys that are equal null-safely hash alike."""
        kinds = {f.name: f.dataType for f in self.schema}
        columns = [F.col(k) + F.lit(0.0) if isinstance(kinds[k], (T.DoubleType, T.FloatType)) else F.col(k) for k in self.keys]
        return F.xxhash64(*columns, F.lit(seed))

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows, which have a ``level``, with the ``word`` and ``mask`` of their key."""
        where = rows.withColumn("_h", self._hashes(0)).withColumn("_m", self._hashes(1))
        word = F.expr(f"shiftrightunsigned(_h, {64 - MOST_LEVEL}) div shiftleft(1L, {MOST_LEVEL} - level)")
        bits = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_m, {6 * i}) & 63 as int))") for i in range(BITS)]
        return where.withColumn("word", word).withColumn("mask", reduce(lambda a, b: a.bitwiseOR(b), bits)).drop("_h", "_m")

    def _merged(self, words: DataFrame) -> DataFrame:
        """One row per word; of a partition built anew only the newest, largest filter."""
        newest = words.groupBy(*self.partitions).agg(F.max("level").alias("level"))
        one = words.groupBy(*self.partitions, "level", "word").agg(F.bit_or("bits").alias("bits"))
        return one.join(newest, [*self.partitions, "level"], "left_semi")

    def _of(self, touched) -> DataFrame:
        """Words of some partitions."""
        return self._merged(self.table.parts().drop("_version").where(in_partitions(touched, self.partitions)))

    # ------------------------------------------------------------ use

    def marked(self, batch: DataFrame, touched) -> DataFrame:
        """The batch with ``known``: whether the table may hold the key. ``touched`` are the batch's partitions.

        Every partition of the batch must have been given to ``prepare``.
        """
        words = self._of(touched)
        levels = words.groupBy(*self.partitions).agg(F.max("level").alias("level"))
        placed = self._placed(batch.join(levels, list(self.partitions), "left"))
        found = placed.join(words, [*self.partitions, "level", "word"], "left")
        known = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
        return found.withColumn("known", known).select(*batch.columns, "known")

    def add(self, batch: DataFrame, touched) -> None:
        """Learn the batch's keys; to be called before its rows are stored."""
        levels = self._of(touched).groupBy(*self.partitions).agg(F.max("level").alias("level"))
        self.table.append(self._filled(batch.join(levels, list(self.partitions))))
        if len(self.table.state().live) >= COMPACT_FROM:
            self.table.compact(self._merged)

    def _filled(self, rows: DataFrame) -> DataFrame:
        return self._placed(rows).groupBy(*self.partitions, "level", "word").agg(F.bit_or("mask").alias("bits"))

    def prepare(self, batch: DataFrame, stored: DataFrame, touched) -> int:
        """Build the filters of the batch's partitions that have none, or would be too full with it, from what is stored.

        Returns how many. ``stored`` is the table and is read in those
        partitions only, and of it the key columns only.
        """
        coming = batch.groupBy(*self.partitions).agg(F.count("*").alias("coming"))
        filled = self._of(touched).groupBy(*self.partitions).agg(F.max("level").alias("level"), F.sum(F.bit_count("bits")).alias("ones"))
        ones = F.coalesce("ones", F.lit(0)) + F.col("coming") * BITS
        full = F.col("level").isNull() | (ones > F.lit(FULL * 64) * F.pow(F.lit(2.0), F.col("level")))
        # at most (number of metrics) x (number of buckets) rows, as in a merge
        todo = coming.join(filled, list(self.partitions), "left").where(full).select(*self.partitions, "coming", "level").collect()
        if not todo:
            return 0
        kept = stored.where(in_partitions(todo, self.partitions)).select(*dict.fromkeys((*self.partitions, *self.keys)))
        names = T.StructType([*(self.schema[p] for p in self.partitions), T.StructField("coming", T.LongType()), T.StructField("before", T.IntegerType())])
        wanted = self.spark.createDataFrame([tuple(row) for row in todo], names)
        counted = wanted.join(kept.groupBy(*self.partitions).agg(F.count("*").alias("held")), list(self.partitions), "left")
        need = F.ceil(F.log2((F.coalesce("held", F.lit(0)) + F.col("coming")) / F.lit(float(KEYS_PER_WORD)))).cast("int") + 2
        level = F.least(F.lit(MOST_LEVEL), F.greatest(F.lit(LEAST_LEVEL), need, F.coalesce(F.col("before") + 1, F.lit(0))))
        levels = counted.select(*self.partitions, level.alias("level"))
        words = self._filled(kept.join(levels, list(self.partitions)))
        # a word without bits says that the partition has a filter, even if nothing is stored there yet
        empty = levels.select(*self.partitions, "level", F.lit(0).cast("long").alias("word"), F.lit(0).cast("long").alias("bits"))
        self.table.append(words.unionByName(empty).to(self.words))
        return len(todo)


def in_partitions(rows, partitions) -> Column:
    """Static partition filter for collected rows: buckets by metric, or just buckets."""
    if len(partitions) == 1:
        return F.col(partitions[0]).isin([r[0] for r in rows])
    by_first = {}
    for row in rows:
        by_first.setdefault(row[0], []).append(row[1])
    return reduce(
        lambda a, b: a | b,
        [(F.col(partitions[0]) == first) & F.col(partitions[1]).isin(seconds) for first, seconds in by_first.items()],
    )
