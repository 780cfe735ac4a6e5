"""Mixing sources to target weights along a time-varying curriculum.

Each source has a total demand (its target, in words) and a schedule: how its
rate changes over training time 0 to 1. The schedule's integral says which
share of the demand is due by a time; its inverse gives every document of the
source, laid end to end in a fixed random order and repeated as often as the
target asks, its time. Documents are then range-sorted by that time.

Long sources are laid out by prefix sums on two levels (4 096 slices of the
random order, then within a slice), so no source meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vitals.llm.common import plain_text, stored

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
#: Knots (time, rate) per schedule, given to sources in turn: early, steady, late.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.2), (0.3, 0.2), (1.0, 1.8)),
)
SLICE_DIGITS = 3
TIME_RANGES = 4096


def word_count(text: str | Column) -> Column:
    return F.regexp_count(plain_text(text), F.lit(WORDS)).cast("long")


def due_time(share: Column, knots) -> Column:
    """Time by which ``share`` (0 to 1) of a source's demand is due: the inverse of the integrated schedule."""
    areas = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(knots, knots[1:])]
    total, done, found = sum(areas), 0.0, None
    for ((t0, r0), (t1, r1)), area in zip(zip(knots, knots[1:]), areas):
        rest = F.greatest(share * F.lit(total) - F.lit(done), F.lit(0.0))
        slope = (r1 - r0) / (t1 - t0)
        # rest = r0 x + slope x^2 / 2, in the form that is stable for small slopes
        root = F.sqrt(F.greatest(F.lit(r0 * r0) + F.lit(2 * slope) * rest, F.lit(0.0)))
        x = F.when(rest <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * rest / (F.lit(r0) + root))
        time = F.least(F.lit(t0) + x, F.lit(t1))
        here = share * F.lit(total) <= F.lit(done + area)
        found = F.when(here, time) if found is None else found.when(here, time)
        done += area
    return found.otherwise(F.lit(knots[-1][0]))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_REPEATS) -> DataFrame:
    """One row per source (``key``, ``source_size``): its ``target`` and place.

    Sources in code-point order, null last, get the weights in turn and share
    ``share`` of all words; none gets over ``most`` times its words, what is
    over goes to the others by weight. That ends where all sources are either
    full or get the same per weight; walking the sources by room per weight
    finds it in one pass.
    """
    alone = W.orderBy(F.col("source").asc_nulls_last())
    place = sizes.withColumn("place", F.row_number().over(alone) - 1)
    place = place.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("double"))
    place = place.withColumn("room", F.col("source_size") * F.lit(float(most))).withColumn("ratio", F.col("room") / F.col("weight"))
    before = W.orderBy("ratio", "place").rowsBetween(W.unboundedPreceding, -1)
    everyone = W.partitionBy()
    level = (F.sum("source_size").over(everyone) * F.lit(share) - F.coalesce(F.sum("room").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    level = place.withColumn("level", level)
    open_level = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "place", "level"))).over(everyone)["level"]
    return level.withColumn("target", F.least(F.col("room"), F.coalesce(F.col("weight") * open_level, F.col("room")))).select(
        "key", "source_size", "target", "place")


def mix(
    docs: DataFrame, doc_id="doc_id", text="text", source="source", keep=(),
    weights=WEIGHTS, share=SHARE, most=MOST_REPEATS, schedules=SCHEDULES,
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, times`` and the struct ``kept`` of ``keep``.

    ``taken`` counts the words the mix takes of the document, repeats
    included, and ``times`` the training time at which each repeat starts. A
    source's taken words add up to its target, rounded down: where the target
    ends within a document, its words up to there count.

    Null texts and texts without words have size 0 and are never taken. A
    null source is a source of its own, a null ``doc_id`` an id of its own.
    Rows that repeat an id count separately; ties in the random order go by id
    and size. An empty table gives an empty result. Only the named columns are
    used, whatever else the table has.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).alias("turn"),
        F.struct(*[F.col(c) for c in keep] or [F.lit(0).alias("none")]).alias("kept"),
    ).withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).withColumn(
        "slice", F.substring("turn", 1, SLICE_DIGITS))
    if not keep:
        rows = stored(rows, "mix-sizes")
    slices = stored(rows.groupBy("key", "source", "slice").agg(F.sum("size").alias("words")), "mix-slices")
    targets = source_targets(slices.groupBy("key", "source").agg(F.sum("words").alias("source_size")), weights, share, most)
    ahead = W.partitionBy("key").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = slices.select("key", "slice", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("slice_start")).join(targets, "key")
    inside = W.partitionBy("key", "slice").orderBy("turn", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    # the sum runs before the join so that long slices move once
    laid = rows.withColumn("inner_start", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["key", "slice"])
    start = F.col("slice_start") + F.col("inner_start")
    due = F.floor("target").cast("long")
    takes, times = [], []
    for repeat in range(most):
        at = start + F.col("source_size") * repeat
        words = F.greatest(F.lit(0), F.least(F.col("size"), due - at))
        takes.append(words)
        chosen = F.lit(None).cast("double")
        for n, knots in enumerate(schedules):
            chosen = F.when(F.col("place") % len(schedules) == n, due_time(F.try_divide(at.cast("double"), F.col("target")), knots)).otherwise(chosen)
        times.append(F.when(words > 0, chosen))
    taken = takes[0]
    for words in takes[1:]:
        taken = taken + words
    return laid.select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"),
        F.array_compact(F.array(*times)).alias("times"), "kept",
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per take, range-sorted by training time; rows of the same time by id."""
    taken = mixed.filter(F.size("times") > 0)
    return taken.select("*", F.posexplode("times").alias("repeat", "time")).orderBy("time", "doc_id", "repeat")


def positions(mixed: DataFrame) -> DataFrame:
    """``mixed``, range-sorted, with ``time`` and ``position`` of each document's first take; those never taken last, with nulls.

    ``position`` counts the words of all takes before it in training order
    (time, then id, size and repeat). Words are summed per range of time first,
    then within a range, so that no task sees all takes.
    """
    taken = mixed.filter(F.size("times") > 0).select("*", F.posexplode("times").alias("repeat", "time"))
    words = F.least(F.col("size"), F.col("taken") - F.col("size") * F.col("repeat"))
    taken = taken.withColumn("words", words).withColumn("range", F.floor(F.col("time") * TIME_RANGES))
    ahead = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # at most TIME_RANGES + 1 rows
    ranges = taken.groupBy("range").agg(F.sum("words").alias("words"))
    ranges = ranges.select("range", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("before"))
    inside = W.partitionBy("range").orderBy("time", "doc_id", "size", "repeat").rowsBetween(W.unboundedPreceding, -1)
    placed = taken.withColumn("inner", F.coalesce(F.sum("words").over(inside), F.lit(0))).join(ranges, "range")
    first = placed.filter("repeat = 0").select(*mixed.columns, "time", (F.col("before") + F.col("inner")).alias("position"))
    never = mixed.filter(F.size("times") == 0).select("*", F.lit(None).cast("double").alias("time"), F.lit(None).cast("long").alias("position"))
    return first.unionByName(never).orderBy(F.col("position").asc_nulls_last(), "doc_id")
