"""Joins by key: outer alignment, upsert, insert-if-absent, reference check."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .ranking import keep_first


def full_outer_by_key(frames: list[DataFrame], keys: tuple[str, ...]) -> DataFrame:
    """Full outer join of frames that each hold one row per key.

    Because keys are unique in every frame, aligning them is one union and one
    grouping instead of a chain of joins that shuffles again at each step.
    Rows with a NULL key are left out. Non-key columns must differ in name.
    """
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    columns = [c for c in united.columns if c not in keys]
    return (
        united.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*[F.any_value(c, ignoreNulls=True).alias(c) for c in columns])
    )


def upsert_by_key(
    existing: DataFrame,
    incoming: DataFrame,
    keys: tuple[str, ...],
    now: Column,
    stamp: str = "updated_at",
) -> DataFrame:
    """``existing`` with ``incoming`` rows replacing or joining it by key.

    A replaced row takes every incoming column, NULLs included. Stamped with
    ``now`` are all incoming rows. Other rows stay as they are.
    """
    stamped = incoming.withColumn(stamp, now).to(existing.schema)
    return existing.join(incoming.select(*keys), list(keys), "left_anti").unionByName(stamped)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``existing`` plus one incoming row for each key it does not hold yet."""
    absent = incoming.join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(keep_first(absent, keys, ()).to(existing.schema))


def require_known_users(
    df: DataFrame, users: DataFrame, user: str = "user_id", username: str = "username"
) -> tuple[DataFrame, DataFrame]:
    """Split rows into those of registered users and the rejected rest."""
    known = users.select(F.col(username).alias(user))
    return df.join(known, user, "left_semi"), df.join(known, user, "left_anti")
