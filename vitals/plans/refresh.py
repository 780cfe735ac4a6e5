"""Gold rows of changed days, from those days and the reach of the others.

A new row changes the figures of its own day, and where overlaps are
suppressed, also those of days whose rows it overlaps. Daily states say which:
a day is touched if a changed day before reaches into it, or if it reaches
into a changed day after it. To recompute a day, its rows are read, those of
the days its rows reach into, and of all other days only how far they reach.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators import reach_names, suppress_overlaps
from . import gold
from .gold import INTERVAL_COLUMNS

#: Table: metrics taken as they are, metrics with overlaps suppressed, builder.
DAILY = {
    "daily_heart_rate_summary": (("heart_rate",), (), gold.daily_heart_rate),
    "daily_activity_summary": ((), gold.MOVEMENT, gold.daily_activity),
    "daily_sleep_summary": (("sleep",), (), gold.daily_sleep),
    "daily_cardiovascular_summary": (tuple(dict.fromkeys(m.metric for m in gold.CARDIOVASCULAR)), (), gold.daily_cardiovascular),
    "daily_respiratory_summary": (("respiratory_rate", "breathing_disturbances"), (), gold.daily_respiratory),
    "daily_metrics_summary": (gold.BODY, (gold.CLIMBED,), gold.daily_metrics),
}

_KEYS = ("user_id", "type", "date")


def _days(first, last):
    return Window.partitionBy("user_id", "type").orderBy("date").rowsBetween(first, last)


def _latest_up_to(value: Column) -> Column:
    return F.max(value).over(_days(Window.unboundedPreceding, Window.currentRow))


def _begins() -> Column:
    return F.col("date").cast("timestamp_ntz")


def _marked(states: DataFrame, changes: DataFrame) -> DataFrame:
    """One row per user, metric and day of states, which may be those of several merges, and changes; ``_held`` has a state, ``_new`` is changed.

    Users without a change are left out. A user's rows lie in one partition, a few a day, so nothing that follows shuffles them again.
    """
    reaches = ("last", *reach_names())
    held = states.select(*_KEYS, "first", *reaches, F.lit(True).alias("_held"), F.lit(False).alias("_new"))
    new = changes.select(*_KEYS, F.lit(False).alias("_held"), F.lit(True).alias("_new"))
    rows = held.unionByName(new, allowMissingColumns=True).repartition("user_id")
    rows = rows.groupBy(*_KEYS).agg(F.min("first").alias("first"), *[F.max(c).alias(c) for c in (*reaches, "_held", "_new")])
    return rows.withColumn("_any", F.max("_new").over(Window.partitionBy("user_id"))).where("_any").drop("_any")


def _with_touched(rows: DataFrame) -> DataFrame:
    new = F.col("_new")
    reached = _latest_up_to(F.when(new, F.col("last"))) > _begins()
    reaches = F.col("last") > F.min(F.when(new, F.col("first"))).over(_days(Window.currentRow, Window.unboundedFollowing))
    return rows.withColumn("_touched", new | F.coalesce(reached, F.lit(False)) | F.coalesce(reaches, F.lit(False)))


def _with_read(rows: DataFrame) -> DataFrame:
    wanted = F.col("_wanted")
    return rows.withColumn("_read", wanted | F.coalesce(_latest_up_to(F.when(wanted, F.col("last"))) > _begins(), F.lit(False)))


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    reach = [F.col(name).alias(f"_{name}") for name in reach_names()]
    return rows.where("_read").select(*_KEYS), rows.where("NOT _read").select("user_id", "type", F.col("date").alias("_day"), *reach)


def touched_days(states: DataFrame, changes: DataFrame) -> DataFrame:
    """User, metric and day of all states whose rows the changed days' rows overlap, those days included."""
    return _with_touched(_marked(states, changes)).where("_touched AND _held").select(*_KEYS)


def read_and_carried(states: DataFrame, days: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For recomputing ``user_id, date`` days of metrics with overlaps: the
    user, metric and day of all rows to read, and the reach of the others."""
    rows = states.join(days.select("user_id").distinct(), "user_id", "left_semi")
    rows = rows.join(days.withColumn("_wanted", F.lit(True)), ["user_id", "date"], "left")
    return _split(_with_read(rows.withColumn("_wanted", F.col("_wanted").isNotNull())))


def days_to_read(states: DataFrame, changes: DataFrame) -> DataFrame:
    """States of the changes' users, with ``_wanted`` on all of a day to recompute and ``_read`` where rows are needed for it.

    Both of ``touched_days`` and ``read_and_carried`` in one shuffle. Changes of
    metrics without overlaps, of which no states are given, only name days.
    """
    rows = _with_touched(_marked(states, changes))
    rows = rows.withColumn("_wanted", F.max("_touched").over(Window.partitionBy("user_id", "date")))
    return _with_read(rows).where("_held").select(*_KEYS, "_wanted", "_read", *reach_names())


def changed_gold(
    records: DataFrame, states: DataFrame, changes: DataFrame, metrics: set[str] | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = lambda rows, name: rows,
) -> dict[str, DataFrame]:
    """Rows of the daily tables that the changes (user, metric, day) can have changed.

    ``states`` are those of all records, the changed ones included; of several
    merges they need not be merged. Equal to the same rows of a full build. A
    day whose rows are all suppressed has no row. ``metrics`` are those that the
    changes name; tables of others are left out. ``keep`` may store rows that
    are used several times under a name.
    """
    metric = "records_type" if "records_type" in records.columns else "type"
    built = {}
    for table, (plain, suppressed, build) in DAILY.items():
        if metrics is not None and metrics.isdisjoint((*plain, *suppressed)):
            continue
        own = changes.where(F.col("type").isin(*plain, *suppressed))
        rows = records.where(F.col(metric).isin(*plain, *suppressed))
        if not suppressed:
            built[table] = build(rows.join(own.select("user_id", "date").distinct(), ["user_id", "date"], "left_semi"))
            continue
        days = keep(days_to_read(states.where(F.col("type").isin(*suppressed)), own), f"{table}_days")
        read, others = _split(days)
        parts = [keep(rows.where(F.col(metric).isin(*suppressed)).join(read, list(_KEYS), "left_semi").select(*INTERVAL_COLUMNS), f"{table}_rows")]
        if plain:
            wanted = days.where("_wanted").select("user_id", "date").unionByName(own.select("user_id", "date")).distinct()
            parts.append(rows.where(F.col(metric).isin(*plain)).join(wanted, ["user_id", "date"], "left_semi").select(*INTERVAL_COLUMNS))
        made = build(reduce(DataFrame.unionByName, parts), suppress=lambda part, others=others: suppress_overlaps(part, earlier=others))
        # Days that were read only because others reach into them, or they into others.
        beside = days.where("_read AND NOT _wanted").select("user_id", "date").distinct()
        built[table] = made.join(beside, ["user_id", "date"], "left_anti")
    return built
