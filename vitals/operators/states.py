"""Daily partial states of records, which merge without reading records again."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import source_priority
from ..schema import SOURCE_RANKING
from .rollup import Measure

STATE_KEYS = ("user_id", "type", "date")


def reach_names(ranking: tuple[str, ...] = SOURCE_RANKING) -> list[str]:
    return [f"reach_{rank}" for rank in range(1, len(ranking) + 1)]


def state_schema(ranking: tuple[str, ...] = SOURCE_RANKING) -> T.StructType:
    def fields(kind, *names):
        return [T.StructField(name, kind) for name in names]

    time = T.TimestampNTZType()
    return T.StructType([
        *fields(T.StringType(), "user_id", "type"), T.StructField("date", T.DateType()), T.StructField("n", T.LongType()),
        *fields(T.DoubleType(), "total", "least", "most"), T.StructField("zero_starts", T.ArrayType(time)),
        *fields(time, "first", "last", *reach_names(ranking)),
    ])


def daily_states(
    records: DataFrame, distinct: tuple[str, ...] = ("stand_hour",), ranking: tuple[str, ...] = SOURCE_RANKING
) -> DataFrame:
    """Per user, metric and day of the start: number, sum, least and greatest of
    the values, first start, last end, and how far rows of each rank or a better
    one reach (``reach_1`` the best source). ``zero_starts`` are the distinct
    starts of rows with value 0.0, kept for the metrics in ``distinct`` only.

    Rows without a start have no day and no state.
    """
    rank = source_priority(F.col("source_name"), ranking)
    bounded = F.col("start_date").isNotNull() & F.col("end_date").isNotNull()
    counted = F.col("type").isin(*distinct) & (F.col("value") == 0.0)
    return (
        records.withColumn("date", F.col("start_date").cast("date")).where(F.col("date").isNotNull())
        .groupBy(*STATE_KEYS)
        .agg(
            F.count("value").alias("n"), F.sum("value").alias("total"), F.min("value").alias("least"), F.max("value").alias("most"),
            F.collect_set(F.when(counted, F.col("start_date"))).alias("zero_starts"),
            F.min("start_date").alias("first"), F.max(F.when(bounded, F.col("end_date"))).alias("last"),
            *[F.max(F.when(bounded & (rank <= r), F.col("end_date"))).alias(name) for r, name in enumerate(reach_names(ranking), 1)],
        )
    )


def merged_states(states: DataFrame, ranking: tuple[str, ...] = SOURCE_RANKING) -> DataFrame:
    """One state per key of states of different rows: what ``daily_states`` of all the rows gives, up to the order of sums."""
    return states.groupBy(*STATE_KEYS).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.array_distinct(F.flatten(F.collect_list("zero_starts"))).alias("zero_starts"),
        F.min("first").alias("first"), *[F.max(c).alias(c) for c in ("last", *reach_names(ranking))],
    )


def state_rollup(states: DataFrame, measures: list[Measure]) -> DataFrame:
    """``daily_rollup`` of the records behind the states, from the states alone.

    Takes measures of values (avg, sum, min, max, count) and distinct starts of
    rows with value 0.0, for metrics without overlap suppression.
    """
    figures = {
        "avg": F.col("total") / F.col("n"), "sum": F.col("total"), "min": F.col("least"), "max": F.col("most"), "count": F.col("n"),
        "count_distinct": F.size("zero_starts"),
    }

    def present(m: Measure) -> Column:
        own = F.col("type") == m.metric
        return own & (F.size("zero_starts") > 0) if m.aggregate == "count_distinct" else own

    def column(m: Measure) -> Column:
        result = F.any_value(F.when(present(m) & (F.col("n") > 0), figures[m.aggregate]), ignoreNulls=True)
        default = 0 if m.aggregate == "count" else m.default
        if default is not None:
            result = F.coalesce(result, F.lit(default))
        return (result.cast(m.cast) if m.cast else result).alias(m.name)

    wanted = reduce(lambda a, b: a | b, [present(m) for m in measures])
    return states.where(wanted).groupBy("user_id", "date").agg(*[column(m) for m in measures])
