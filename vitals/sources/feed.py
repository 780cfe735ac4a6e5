"""What merges changed: days to recompute, and daily states kept beside the records.

A merge first writes the rows it is about to add, then a mark naming them, and
only then adds them, records the days and states and takes the mark away. Each
step can be repeated without effect, and the next merge finishes a marked one,
so a break loses no change and counts no row twice. One writer at a time merges
into a table.
"""

import json
import posixpath
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import daily_states, merged_states, state_schema
from ..session import drop_shuffles
from .versions import VersionedTable, _hadoop, create_if_absent

CHANGES = "user_id string, type string, date date"


class Feed:
    """A folder with ``changes/run=<id>``, the versioned ``states`` and at most one `mark.json`."""

    def __init__(self, spark: SparkSession, path: str, with_states: bool = True):
        self.spark, self.path, self.with_states = spark, path, with_states
        self._states = VersionedTable(spark, posixpath.join(path, "states"), state_schema(), ("user_id", "type", "date"), ("type",))

    def _under(self, *names: str) -> str:
        return posixpath.join(self.path, *names)

    # ------------------------------------------------------------ writing

    def apply(self, fresh: DataFrame, add: Callable[[DataFrame], None]) -> None:
        """Add ``fresh`` rows by ``add``, which must leave out what is there already, and record them."""
        run = uuid.uuid4().hex
        fresh.write.option("compression", "zstd").parquet(self._under("_fresh", f"run={run}"))
        if not create_if_absent(self.spark, self._under("mark.json"), json.dumps({"run": run})):
            raise RuntimeError(f"another merge is under way at {self.path}")
        self._finish(run, fresh.schema, add)

    def finish(self, schema, add: Callable[[DataFrame], None]) -> bool:
        """Finish a merge that broke off, if there is one; says whether there was."""
        location, files = _hadoop(self.spark, self._under("mark.json"))
        if not files.exists(location):
            return False
        run = self.spark.read.schema("run string").json(self._under("mark.json")).first()["run"]
        self._finish(run, schema, add)
        return True

    def _finish(self, run: str, schema, add) -> None:
        staged = self._under("_fresh", f"run={run}")
        rows = self.spark.read.schema(schema).parquet(staged)
        metric = F.col("type") if "type" in rows.columns else F.lit("workout").alias("type")
        changed = rows.select("user_id", metric, "date").where("date IS NOT NULL").distinct()
        changed.write.mode("overwrite").parquet(self._under("changes", f"run={run}"))
        drop_shuffles(self.spark)  # what found the rows; adding them shuffles all of them again
        add(rows)
        if self.with_states:
            self._states.append(daily_states(rows), run)
        for path in (self._under("mark.json"), staged):
            location, files = _hadoop(self.spark, path)
            files.delete(location, True)

    # ------------------------------------------------------------ reading

    def runs(self) -> list[str]:
        """Merges whose days nobody has taken in yet; one name per merge."""
        location, files = _hadoop(self.spark, self._under("changes"))
        return sorted(s.getPath().getName() for s in files.listStatus(location)) if files.exists(location) else []

    def changes(self, runs: list[str]) -> DataFrame:
        """Distinct user, metric and day of the merges."""
        if not runs:
            return self.spark.createDataFrame([], CHANGES)
        return self.spark.read.schema(CHANGES).parquet(*[self._under("changes", run) for run in runs]).distinct()

    def clear(self, runs: list[str]) -> None:
        """Forget merges whose days have been taken in."""
        for run in runs:
            location, files = _hadoop(self.spark, self._under("changes", run))
            files.delete(location, True)

    def states(self) -> DataFrame:
        """One state per user, metric and day of all recorded rows."""
        return merged_states(self.state_parts())

    def state_parts(self) -> DataFrame:
        """The states as merges left them, several to a user, metric and day."""
        return self._states.parts().drop("_version")

    def compact(self, least: int = 2) -> None:
        self._states.compact(merged_states, least)
