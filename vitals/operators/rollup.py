"""Several daily measures in one pass over the records."""

from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

_AGGREGATES = {
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "count_distinct": F.count_distinct,
}


@dataclass(frozen=True)
class Measure:
    """One output column: ``aggregate(value)`` over the rows of one metric.

    ``only`` limits the rows further. A day that has no row passing any
    measure's conditions is absent from the result.
    """

    name: str
    metric: str
    aggregate: str
    value: str = "value"
    only: Column | None = None
    default: Any = None
    cast: str | None = None


def daily_rollup(
    records: DataFrame,
    measures: list[Measure],
    by: tuple[str, ...] = ("user_id",),
    metric: str = "type",
    start: str = "start_date",
) -> DataFrame:
    """Measures per group and calendar day of the interval start.

    Equals a full outer join of one aggregation per measure, but reads the
    records once and shuffles only partial aggregates.
    """
    def applies(m: Measure) -> Column:
        own = F.col(metric) == m.metric
        return own if m.only is None else own & m.only

    def column(m: Measure) -> Column:
        result = _AGGREGATES[m.aggregate](F.when(applies(m), F.col(m.value)))
        if m.default is not None:
            result = F.coalesce(result, F.lit(m.default))
        return (result.cast(m.cast) if m.cast else result).alias(m.name)

    # Equal conditions are stated once, so a single-metric table filters on
    # just that metric and partitions of other metrics are never read.
    conditions = {(m.metric, str(m.only)): applies(m) for m in measures}
    plain = sorted({m.metric for m in measures})
    return (
        records.where(F.col(metric).isin(plain))
        .where(reduce(lambda a, b: a | b, conditions.values()))
        .withColumn("date", F.col(start).cast("date"))
        .where(F.col("date").isNotNull())
        .groupBy(*by, "date")
        .agg(*[column(m) for m in measures])
    )
