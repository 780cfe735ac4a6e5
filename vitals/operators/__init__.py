"""Relational operators on DataFrames."""

from .joins import full_outer_by_key, insert_if_absent, require_known_users, upsert_by_key
from .overlap import suppress_overlaps
from .ranking import keep_first, latest_per_user, top_n
from .rollup import Measure, daily_rollup
from .states import daily_states, merged_states, reach_names, state_rollup, state_schema

__all__ = [
    "full_outer_by_key", "insert_if_absent", "require_known_users", "upsert_by_key",
    "suppress_overlaps", "keep_first", "latest_per_user", "top_n", "Measure", "daily_rollup",
    "daily_states", "merged_states", "reach_names", "state_rollup", "state_schema",
]
