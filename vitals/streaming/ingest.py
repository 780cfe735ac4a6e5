"""Take in new export archives as they arrive."""

import posixpath
import threading
import uuid
from collections.abc import Callable

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import USER_FOLDER, Lake, kept_listing, land_listed, listed_users, load_silver, pending, refresh_changed
from ..sources import tables
from ..sources.archives import list_archives, with_path_user, with_user
from ..sources.versions import _hadoop

_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTED = "path string, modificationTime timestamp, length long"
_NOTED = _LISTED + ", user_id string"

#: Batches are noted and worked off together once their archives have so many bytes.
GROUP_BYTES = 512 << 20


class Ingest(StreamingQuery):
    """The stream's query; it ends after its last batch and all archives noted before are worked off."""

    def __init__(self, spark: SparkSession, query: StreamingQuery, finish: Callable[[], None]):
        super().__init__(query._jsq)
        self._failed, self._stopped = None, False
        self._end = threading.Thread(target=inheritable_thread_target(spark)(self._run), args=(query, finish), daemon=True)
        self._end.start()

    def _run(self, query: StreamingQuery, finish: Callable[[], None]) -> None:
        try:
            query.awaitTermination()
            if not self._stopped:
                finish()
        except Exception as error:
            self._failed = error

    @property
    def isActive(self) -> bool:
        return self._end.is_alive()

    def awaitTermination(self, timeout: int | None = None) -> bool | None:
        self._end.join(timeout)
        if self._failed is not None:
            raise self._failed
        return None if timeout is None else not self._end.is_alive()

    def exception(self):
        return super().exception() or self._failed

    def stop(self) -> None:
        """Archives noted but not worked off are found by the next stream into the lake."""
        self._stopped = True
        super().stop()
        self._end.join()


def ingest_archives(
    spark: SparkSession,
    lake: Lake,
    source: str,
    checkpoint: str,
    user_pattern: str = USER_FOLDER,
    now: Column | None = None,
    max_files_per_batch: int = 10_000,
    trigger: dict | None = None,
    registered: DataFrame | None = None,
) -> StreamingQuery:
    """Stream archives through bronze, silver and gold.

    By default everything present is processed and the query ends. A batch that
    is replayed after a failure changes nothing: landing goes by content,
    merging by row key and gold by upsert of the days that changed. There is no watermark, since an
    export always repeats a user's old rows and late rows must count. With
    ``registered`` users, gold takes rows of those only.

    Merging reads the stored keys and starts some hundred jobs however small the
    batch is. So a stream that ends by itself only notes the archives of a batch
    and works them off with those of other batches, at ``GROUP_BYTES`` or at its
    end. Notes lie in the lake until gold has their rows. Spark's source of files
    would hold all names in the driver; such a stream has tasks list the archives
    first and streams the files of that listing, a batch each, which lie below
    ``checkpoint`` and say what has been listed before.

    A stream that goes on finds archives by Spark's source and works off every
    batch at once. Spark lists a batch's files anew, by default in a task each;
    the session's setting for that is lowered to a few tasks per core.
    """
    tasks = min(int(spark.conf.get(_LISTING, "10000")), 4 * spark.sparkContext.defaultParallelism)
    spark.conf.set(_LISTING, str(tasks))
    trigger = trigger or {"availableNow": True}
    ends = bool(trigger.get("availableNow") or trigger.get("once"))
    if ends:
        listing = posixpath.join(checkpoint, "listing")
        list_new(spark, lake, source, listing, max_files_per_batch)
        arrivals = (
            spark.readStream.schema(_LISTED)
            .option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", 1)
            .option("maxFileAge", "36500d")  # what an old listing names is in no newer one
            .parquet(listing)
        )
        checkpoint = posixpath.join(checkpoint, "listed")
    else:
        arrivals = (
            spark.readStream.format("binaryFile")
            .schema(_LISTED + ", content binary")
            .option("pathGlobFilter", "*.zip")
            .option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", max_files_per_batch)
            .load(source)
            .select("path", "modificationTime", "length")  # contents stay unread
        )
    waiting = 0  # bytes this stream has noted and not worked off

    def load(batch: DataFrame, batch_id: int) -> None:
        nonlocal waiting
        waiting += note_archives(lake, with_path_user(batch, user_pattern))
        if ends and waiting < GROUP_BYTES:
            return
        work_off(batch.sparkSession, lake, user_pattern, now, registered)
        waiting = 0

    query = arrivals.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    return Ingest(spark, query, lambda: work_off(spark, lake, user_pattern, now, registered) if ends else None)


def list_new(spark: SparkSession, lake: Lake, source: str, listing: str, per_file: int) -> None:
    """List the archives below ``source`` that are not in the listing yet, in files of at most ``per_file``."""
    with kept_listing(spark, lake, list_archives(spark, source)) as found:
        location, files = _hadoop(spark, listing)
        files.mkdirs(location)
        seen = spark.read.schema(_LISTED).option("recursiveFileLookup", "true").parquet(listing)
        new = found.join(seen, ["path", "modificationTime", "length"], "left_anti")
        count = new.count()
        if count:
            tasks = min(2 * spark.sparkContext.defaultParallelism, max(1, count // (4 * per_file)))
            new.coalesce(tasks).write.options(maxRecordsPerFile=per_file, compression="zstd").parquet(
                posixpath.join(listing, f"run={uuid.uuid4().hex}"))


def _notes(lake: Lake) -> str:
    return posixpath.join(lake.staging, "arrived")


def note_archives(lake: Lake, listed: DataFrame) -> int:
    """Keep a listing of archives in the lake until they are worked off; returns their bytes."""
    session, seen = listed.sparkSession, Observation()
    rows = listed.observe(seen, F.coalesce(F.sum("length"), F.lit(0)).alias("size"))
    rows.coalesce(2 * session.sparkContext.defaultParallelism).write.parquet(posixpath.join(_notes(lake), f"run={uuid.uuid4().hex}"))
    return seen.get["size"]


def work_off(
    spark: SparkSession, lake: Lake, user_pattern: str = USER_FOLDER, now: Column | None = None, registered: DataFrame | None = None
) -> None:
    """Take all noted archives through bronze, silver and gold.

    What a failed attempt left undone is found again: archives by their notes,
    silver by archives landed but not loaded, gold by the changes not taken in yet.
    """
    location, files = _hadoop(spark, _notes(lake))
    notes = [status.getPath().toString() for status in files.listStatus(location)] if files.exists(location) else []
    if not notes:
        return
    stamp = F.current_timestamp() if now is None else now
    with kept_listing(spark, lake, spark.read.schema(_NOTED).parquet(*notes)) as listed:
        land_listed(spark, lake, listed, user_pattern)
        with listed_users(spark, lake, with_user(listed, user_pattern)) as users:
            load_silver(spark, lake, pending(spark, lake, users), stamp)
    refresh_changed(spark, lake, stamp, registered)
    for note in notes:
        tables.remove(spark, note)
