"""Tables of immutable versions with a commit log.

A writer puts its rows into a folder of its own and then commits: it writes the
next numbered file of the log, which lists every live folder, if that number is
not taken yet. Whoever comes second reads the log again and tries the next
number, so writers beside each other lose nothing and nobody waits for a lock.
Nothing live is ever changed in place: a write costs bytes in proportion to its
rows, a reader sees one commit from start to end, and a break before the commit
leaves a folder that nobody lists.

Readers of keyed tables take the newest version of each key. Compaction is
separate: it merges the folders it found into one with the same place in the
order, and commits only if all of them are still live.
"""

import json
import os
import posixpath
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators import top_n

_NAME = "{:020d}.json"
_IDS_KEPT = 1000


class Conflict(Exception):
    """What a commit was based on is no longer live."""


def _hadoop(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless there is one; says whether it did. One of several writers wins.

    A finished temporary file takes the name: by a link on a local file system,
    elsewhere by a rename that does not overwrite.
    """
    location, files = _hadoop(spark, path)
    temporary = f"{posixpath.dirname(path)}/_{uuid.uuid4().hex}.tmp"
    if files.getScheme() == "file":
        target = location.toUri().getPath()
        os.makedirs(os.path.dirname(target), exist_ok=True)
        own = _hadoop(spark, temporary)[0].toUri().getPath()
        with open(own, "w", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(own, target)
            return True
        except FileExistsError:
            return False
        finally:
            os.remove(own)
    own, _ = _hadoop(spark, temporary)
    out = files.create(own, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    plain = spark.sparkContext._gateway.new_array(rename, 1)
    plain[0] = rename.NONE
    try:
        context.rename(own, location, plain)
        return True
    except Exception:
        files.delete(own, False)
        if files.exists(location):
            return False
        raise


@dataclass(frozen=True)
class State:
    """One commit: its number, the live folders, oldest first, and what the table was created with."""

    number: int
    live: tuple[dict, ...]
    options: dict


class VersionedTable:
    """A folder with ``data/run=<id>/`` and ``_commits/<number>.json``.

    ``options`` are fixed when the table is created (``buckets``, say); whoever
    creates it first decides.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: tuple[str, ...],
                 partitions: tuple[str, ...] = (), **options):
        self.spark, self.path, self.schema, self.keys, self.partitions, self.wanted = spark, path, schema, keys, partitions, options

    @property
    def _log(self) -> str:
        return posixpath.join(self.path, "_commits")

    @property
    def _data(self) -> str:
        return posixpath.join(self.path, "data")

    # ------------------------------------------------------------ the log

    def exists(self) -> bool:
        location, files = _hadoop(self.spark, posixpath.join(self._log, _NAME.format(0)))
        return files.exists(location)

    def _numbers(self) -> list[int]:
        location, files = _hadoop(self.spark, self._log)
        if not files.exists(location):
            return []
        names = [status.getPath().getName() for status in files.listStatus(location)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0].isdigit())

    def _commit_at(self, number: int) -> dict:
        location, files = _hadoop(self.spark, posixpath.join(self._log, _NAME.format(number)))
        stream = files.open(location)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def state(self) -> State:
        """The newest commit; creates an empty table if there is none."""
        numbers = self._numbers()
        if not numbers:
            create_if_absent(self.spark, posixpath.join(self._log, _NAME.format(0)), json.dumps({"live": [], "options": self.wanted, "retired": []}))
            numbers = self._numbers()
        found = self._commit_at(numbers[-1])
        return State(numbers[-1], tuple(found["live"]), found["options"])

    def _commit(self, change: Callable[[State], tuple[list[dict], list[str]] | None]) -> int | None:
        """Commits what ``change`` makes of the newest state, again and again until no other writer was faster."""
        while True:
            state = self.state()
            changed = change(state)
            if changed is None:
                return None
            live, retired = changed
            text = json.dumps({"live": live, "options": state.options, "retired": retired})
            if create_if_absent(self.spark, posixpath.join(self._log, _NAME.format(state.number + 1)), text):
                return state.number + 1

    # ------------------------------------------------------------ writing

    def _write(self, rows: DataFrame, run: str) -> str:
        folder = f"run={run}"
        by = [*self.partitions, *(c for c in self.keys if c not in self.partitions)]
        laid = rows.hint("rebalance", *[F.col(p) for p in self.partitions]) if self.partitions else rows.hint("rebalance")
        laid.sortWithinPartitions(*by).write.mode("overwrite").option("compression", "zstd").partitionBy(*self.partitions).parquet(posixpath.join(self._data, folder))
        return folder

    def append(self, rows: DataFrame, run: str | None = None) -> int | None:
        """Add rows as one version. A ``run`` that is in the log already is not added again (None)."""
        run = run or uuid.uuid4().hex
        if any(run in entry["ids"] for entry in self.state().live):
            return None
        folder = self._write(rows.to(self.schema), run)

        def add(state):
            if any(run in entry["ids"] for entry in state.live):
                return None
            return [*state.live, {"folder": folder, "version": state.number + 1, "ids": [run]}], []

        return self._commit(add)

    def compact(self, merged: Callable[[DataFrame], DataFrame] | None = None, least: int = 2) -> int | None:
        """Merge the live folders into one, if there are ``least`` or more.

        Rows committed meanwhile stay and stay newer. Raises ``Conflict`` if
        another compaction came first; the table is right either way.
        """
        before = self.state()
        if len(before.live) < least:
            return None
        rows = self._newest(before) if merged is None else merged(self._parts(before.live).drop("_version"))
        run = uuid.uuid4().hex
        folder = self._write(rows.to(self.schema), run)
        folders = [entry["folder"] for entry in before.live]
        ids = [i for entry in before.live for i in entry["ids"]][-_IDS_KEPT:]
        one = {"folder": folder, "version": before.live[-1]["version"], "ids": ids}

        def replace(state):
            if [entry["folder"] for entry in state.live[:len(folders)]] != folders:
                raise Conflict(f"{self.path} was compacted by another writer")
            return [one, *state.live[len(folders):]], folders

        return self._commit(replace)

    def vacuum(self, keep: int = 1) -> int:
        """Delete folders that no commit but the oldest lists, keeping the newest ``keep`` commits readable; returns how many.

        Only folders that a compaction retired go; what another writer has not
        committed yet is unknown here and stays.
        """
        numbers, gone = self._numbers(), 0
        for number in numbers[1:]:
            if number > numbers[-1] - keep + 1:
                break
            for folder in self._commit_at(number)["retired"]:
                location, files = _hadoop(self.spark, posixpath.join(self._data, folder))
                gone += bool(files.delete(location, True))
        for number in numbers[1:-max(1, keep)]:
            location, files = _hadoop(self.spark, posixpath.join(self._log, _NAME.format(number)))
            files.delete(location, False)
        return gone

    # ------------------------------------------------------------ reading

    def _parts(self, live) -> DataFrame:
        if not live:
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("_version", T.LongType())]))
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("run", T.StringType())])).option(
            "basePath", self._data).parquet(*[posixpath.join(self._data, entry["folder"]) for entry in live])
        version = F.create_map(*[F.lit(v) for entry in live for v in (entry["folder"].removeprefix("run="), entry["version"])])
        return rows.withColumn("_version", F.element_at(version, F.col("run")).cast("long")).drop("run").select(*self.schema.names, "_version")

    def parts(self) -> DataFrame:
        """All live rows with the ``_version`` that added them."""
        return self._parts(self.state().live)

    def read(self) -> DataFrame:
        """The newest row of each key."""
        return self._newest(self.state())

    def _newest(self, state: State) -> DataFrame:
        """The oldest folder, usually a large compacted one, less the keys of
        the others: where those are few, Spark broadcasts them and the large
        folder is not shuffled. Filters on partition columns reach all scans."""
        if len(state.live) < 2:
            return self._parts(state.live).drop("_version")
        on = [*self.partitions, *(k for k in self.keys if k not in self.partitions)]
        later = top_n(self._parts(state.live[1:]), tuple(on), 1, [F.col("_version").desc()]).drop("_version")
        first = self._parts(state.live[:1]).drop("_version")
        return first.join(later.select(*on), on, "left_anti").select(*self.schema.names).unionByName(later)
