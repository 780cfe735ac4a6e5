"""Keep-first and newest-N selection within groups.

All of these filter ``row_number`` by a small constant, which Spark turns into
a group limit before the shuffle: each task forwards at most N rows per group,
so a group holding a large share of all rows never meets in one task.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n(df: DataFrame, by: tuple[str, ...], n: int, order: list[Column]) -> DataFrame:
    """First ``n`` rows of each group in the given order."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).where(F.col("_row") <= n).drop("_row")


def keep_first(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row per key: the first by ``order``, then by all other columns.

    The tie-break makes the choice the same on every run. NULL keys form one
    group, as NaN keys do.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    return top_n(df, keys, 1, [F.col(c).asc_nulls_last() for c in (*order, *rest)])


def latest_per_user(df: DataFrame, date: str = "date", user: str = "user_id") -> DataFrame:
    """Newest row of each user."""
    return top_n(df, (user,), 1, [F.col(date).desc_nulls_last()])
