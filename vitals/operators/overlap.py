"""Overlap suppression between measurement sources of different rank."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import source_priority
from ..schema import SOURCE_RANKING


def suppress_overlaps(
    df: DataFrame,
    keys: tuple[str, ...] = ("user_id", "type"),
    start: str = "start_date",
    end: str = "end_date",
    source: str = "source_name",
    ranking: tuple[str, ...] = SOURCE_RANKING,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Drop each row overlapped by a row of a better-ranked source.

    A row goes when another row with equal keys has a better rank, starts
    before this row ends and ends after this row starts. Rows that are dropped
    themselves still suppress others; rows with a missing bound are kept and
    suppress nothing; duplicates stay duplicated.

    The test needs, at each row's end, only one number per rank: how far the
    better-ranked rows that started earlier reach. So instead of a range join:

    1. starts and ends become points in time, merged where equal (map side
       first, so copies collapse before the shuffle);
    2. a running maximum over the points of one (keys, day) gives the reach,
       and one extra row brings in the reach of all earlier days;
    3. rows look up the reach at their end with an equality join. Best-ranked
       rows always stay and skip the join.

    On whole-second data a (keys, day) window holds at most 2 x 86400 points
    plus one, whatever the number of rows, and the window over days one row per
    day. A hot key is thus cut into days, and the lookup join is one that
    adaptive execution can split.

    Where ``df`` holds some days only, ``earlier`` tells how far the others
    reach: the keys, ``_day`` (of the starts) and ``_reach_1`` to the last rank,
    of days of which ``df`` has no row.
    """
    ranks = len(ranking)
    rank = source_priority(F.col(source), ranking)
    points = _points(df, keys, start, end, rank, ranks)
    reach = _reach_at_ends(points, keys, end, ranks, earlier)

    best = df.where(rank == 1)
    others = df.where(rank > 1).join(reach, [*keys, end], "left")
    reached = F.element_at(F.array(*_reach_columns(ranks)), rank - 1)
    kept = others.where(~F.coalesce(reached > F.col(start), F.lit(False)))
    return best.unionByName(kept.select(*df.columns))


def _reach_columns(ranks: int) -> list[str]:
    return [f"_reach_{rank}" for rank in range(1, ranks + 1)]


def _latest(ranks: int) -> list[Column]:
    return [F.max(c).alias(c) for c in _reach_columns(ranks)]


def _any_reach(ranks: int) -> Column:
    return F.coalesce(*_reach_columns(ranks)).isNotNull()


def _points(df: DataFrame, keys, start, end, rank: Column, ranks: int) -> DataFrame:
    """Points in time of the rows: kind 1 = starts, kind 0 = ends.

    A start carries, for each rank, the row's end if the row has that rank or a
    better one. The worst rank suppresses nothing and the best rank is never
    suppressed, so they give no starts and no ends respectively.
    """
    begins, finishes = F.col(start), F.col(end)
    bounded = begins.isNotNull() & finishes.isNotNull()

    def point(at, kind, reaches):
        return F.struct(
            at.alias("_at"), F.lit(kind).alias("_kind"),
            *[r.alias(name) for name, r in zip(_reach_columns(ranks), reaches)],
        )

    starts = point(
        F.when(bounded & (rank <= ranks), begins), 1,
        [F.when(rank <= r, finishes) for r in range(1, ranks + 1)],
    )
    ends = point(
        F.when(bounded & (rank > 1), finishes), 0,
        [F.when(F.lit(False), finishes)] * ranks,
    )
    return (
        df.select(*keys, F.inline(F.array(starts, ends)))
        .where(F.col("_at").isNotNull())
        .withColumn("_day", F.col("_at").cast("date"))
    )


def _reach_at_ends(points: DataFrame, keys, end, ranks: int, earlier: DataFrame | None = None) -> DataFrame:
    """Reach of each rank at every end: latest end of rows started before it."""
    merged = points.groupBy(*keys, "_day", "_at", "_kind").agg(*_latest(ranks))
    earlier_days = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = merged.groupBy(*keys, "_day").agg(*_latest(ranks))  # the same shuffled points, read again
    if earlier is not None:
        days = days.unionByName(earlier.select(*keys, "_day", *_reach_columns(ranks)))
        days = days.groupBy(*keys, "_day").agg(*_latest(ranks))  # an end may lie on a day that is not in df
    carried = (
        days.select(*keys, "_day", *[F.max(c).over(earlier_days).alias(c) for c in _reach_columns(ranks)])
        .where(_any_reach(ranks))
    )
    # The carried row has no time and sorts first. At equal times ends sort
    # before starts: touching intervals do not overlap.
    within_day = (
        Window.partitionBy(*keys, "_day")
        .orderBy(F.col("_at").asc_nulls_first(), "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        merged.unionByName(carried, allowMissingColumns=True)
        .select(*keys, F.col("_at").alias(end), "_kind", *[F.max(c).over(within_day).alias(c) for c in _reach_columns(ranks)])
        .where((F.col("_kind") == 0) & _any_reach(ranks))
        .drop("_kind")
    )
