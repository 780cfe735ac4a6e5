"""Raw export archives: landing them and unpacking their XML.

Both steps are Python tasks over a list of archives, one archive at a time and
a block of bytes at a time; only parts of exports up to ``PACKED_BYTES`` become
column values, so the 2 GB limit of a binary column does not apply. File access
goes through ``pyarrow.fs``, which takes local paths and object-store URIs alike.

Tasks may run twice (lost executors, speculation). Each writes under a name of
its own attempt and moves the finished file into place, so a rerun replaces a
file by the same bytes; files that several archives share have a new name in
each attempt, and those of a lost one are taken away.
"""

import hashlib
import io
import posixpath
import re
import sys
import uuid
import zipfile
import zlib
from contextlib import contextmanager
from urllib.parse import quote
from xml.parsers import expat

import pandas as pd
import pyarrow as pa
from pyarrow import ArrowInvalid, fs as arrow_fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import keep_first
from ..session import drop_shuffles
from .tables import exists, remove

BLOCK = 1 << 20
EXPORT_NAME = "export.xml"

_LANDED = "user_id string, source string, length long, modified long, sha256 string, archive string"
#: Sound archives up to this size are kept one after another in files of about ``PACK_BYTES``.
SMALL_BYTES = 256 << 10
PACK_BYTES = 256 << 20
_PLACE = re.compile(r"(.*\.pack)#(\d+)\+(\d+)/[0-9a-f]{64}\.zip", re.DOTALL)

UNPACKED = "user_id string, sha256 string, part string, bytes long, error string"

#: Parts up to this size are rows of a table, larger ones files; of one archive at most ``ARCHIVE_BYTES`` are.
PACKED_BYTES = 256 << 10
ARCHIVE_BYTES = 16 << 20
PACKS = "packs"
#: Where in a part the elements of a tag stand, in bytes.
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
TAGS = ("Record", "Workout")
_TWO_BYTES = (b"\xff\xfe", b"\xfe\xff")  # what a text of two-byte characters starts with
_PACKED = pa.schema([("user_id", pa.string()), ("sha256", pa.string()), ("part", pa.string()), ("bytes", pa.int64()),
                     ("error", pa.string()), ("document", pa.binary()), *((tag, _SPANS) for tag in TAGS)])
PACKED = UNPACKED + ", document binary" + "".join(f", {tag} array<struct<start: int, length: int>>" for tag in TAGS)


# Tasks carry this module's functions, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def open_fs(uri: str):
    """File system and path of a URI or plain path, as Spark writes them."""
    if uri.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    for scheme in ("s3a://", "s3n://"):
        if uri.startswith(scheme):
            uri = "s3://" + uri.removeprefix(scheme)
    return arrow_fs.FileSystem.from_uri(uri)


_FOUND = "path string, modified long, length long, folder boolean"


def list_archives(spark: SparkSession, source: str) -> DataFrame:
    """Archives at any depth below ``source``; their contents are not read.

    A task lists the folder itself and others the folders in it, so neither the
    driver nor a plan holds the names. Hidden names count as Spark counts them.
    """
    location = spark._jvm.org.apache.hadoop.fs.Path(source)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    roots = [(status.getPath().toString(),) for status in files.globStatus(location) or []]
    if not roots:
        raise FileNotFoundError(source)
    top = spark.createDataFrame(roots, "path string").mapInPandas(_list_task(deep=False), _FOUND)
    folders = top.where("folder").select("path").repartition(2 * spark.sparkContext.defaultParallelism, "path")
    found = top.where("NOT folder").unionByName(folders.mapInPandas(_list_task(deep=True), _FOUND))
    return found.select("path", F.timestamp_millis("modified").alias("modificationTime"), "length")


def _list_task(deep: bool):
    def run(batches):
        for batch in batches:
            rows = []
            for path in batch["path"]:
                for row in _listed(path, deep):
                    rows.append(row)
                    if len(rows) >= 10_000:
                        yield pd.DataFrame(rows, columns=["path", "modified", "length", "folder"])
                        rows = []
            yield pd.DataFrame(rows, columns=["path", "modified", "length", "folder"])

    return run


def _listed(path: str, deep: bool):
    """Archives in a folder, and its folders or what they hold; a path that is a file gives itself."""
    files, root = open_fs(path)
    prefix = path.removesuffix(root.lstrip("/").rstrip("/")) if "://" in path else "file:"
    waiting = [files.get_file_info(root)]
    for info in waiting:
        inner = [info]
        if info.type == arrow_fs.FileType.Directory:
            inner = [i for i in files.get_file_info(arrow_fs.FileSelector(info.path)) if not _hidden(i.base_name)]
        for each in inner:
            if each.type != arrow_fs.FileType.Directory:
                if each.base_name.endswith(".zip"):
                    yield prefix + each.path, (each.mtime_ns or 0) // 1_000_000, each.size, False
            elif deep:
                waiting.append(each)
            else:
                yield prefix + each.path, 0, 0, True


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def with_path_user(listed: DataFrame, user_pattern: str) -> DataFrame:
    """Adds ``user_id``, the first group of the pattern in the path; NULL where it is missing or could step out of its folder.

    The pattern is tried once a path: as plain expressions, the tests and each
    filter on them would try it again.
    """
    found = F.array(F.regexp_extract("path", user_pattern, 1))
    safe = F.filter(found, lambda user: (user != "") & ~user.isin(".", "..") & ~user.contains("/"))
    return listed.withColumn("user_id", F.get(safe, F.lit(0)))


def _with_path_user(listed: DataFrame, user_pattern: str) -> DataFrame:
    return listed if "user_id" in listed.columns else with_path_user(listed, user_pattern)


def with_user(listed: DataFrame, user_pattern: str) -> DataFrame:
    """Adds the user id found in the path; archives without a safe one are left out (see ``without_user``).

    A listing that has the column ``user_id`` already is taken as it is.
    """
    return _with_path_user(listed, user_pattern).select(
        "user_id",
        F.col("path").alias("source"),
        "length",
        F.unix_micros("modificationTime").alias("modified"),
    ).where(F.col("user_id").isNotNull())


def without_user(listed: DataFrame, user_pattern: str) -> DataFrame:
    """Archives whose path yields no safe user id, with the reason."""
    return _with_path_user(listed, user_pattern).where("user_id IS NULL").select(
        F.col("path").alias("source"), "length", F.lit("no safe user id in the path").alias("error"))


def _spread(archives: DataFrame, bytes_per_task: int = 256 << 20) -> DataFrame:
    """Spreads archives over tasks by their bytes.

    To Spark each archive is one short row, so left alone a few tasks would get
    hours of copying. Only a count and a sum come to the driver.
    """
    files, size = archives.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    cores = archives.sparkSession.sparkContext.defaultParallelism
    tasks = min(files, max(2 * cores, -(-size // bytes_per_task)))
    return archives.repartition(max(1, tasks), "source")


def land_archives(spark: SparkSession, listed: DataFrame, bronze: str) -> DataFrame:
    """Copy archives not seen before to bronze.

    Small ones are put one after another into few files below ``bronze/_packs``,
    as a folder and a file of its own would cost each two blocks of the disk.
    Large ones, and what does not look like an archive and may be put right
    there, are files ``bronze/<user>/<sha256>.zip``. What is there stays
    untouched; the catalog in ``bronze/_catalog`` gets one row per new archive,
    which says where it is. Returns the rows added.
    """
    drop_shuffles(spark)
    catalog_path = posixpath.join(bronze, "_catalog")
    known = read_catalog(spark, bronze)
    unseen = listed.join(known, ["user_id", "source", "length", "modified"], "left_anti")
    run = uuid.uuid4().hex
    packs = posixpath.join(bronze, "_packs", f"run={run}")
    copied = _spread(unseen).mapInPandas(_copy_task(bronze, packs), _LANDED)
    # Same bytes under a new name are the same archive.
    fresh = (
        keep_first(copied, ("user_id", "sha256"), ("source",))
        .join(known, ["user_id", "sha256"], "left_anti")
        .withColumn("run", F.lit(run))
    )
    fresh.write.mode("append").option("compression", "zstd").partitionBy("run").parquet(catalog_path)
    added = spark.read.schema(_LANDED + ", run string").parquet(catalog_path).where(F.col("run") == run).drop("run")
    _remove_unused(spark, packs, added)
    return added


def _remove_unused(spark: SparkSession, packs: str, added: DataFrame) -> None:
    """Take away packs of which no archive is new, as well as those that broken tasks left."""
    if exists(spark, packs):
        pack = F.regexp_extract("archive", r"([^/]*\.pack)#[^/]*/[^/]*$", 1)
        used = {row["pack"] for row in added.select(pack.alias("pack")).distinct().collect()}  # a few per task
        location = spark._jvm.org.apache.hadoop.fs.Path(packs)
        for status in location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(location):
            if status.getPath().getName() not in used:
                remove(spark, status.getPath().toString())


def read_catalog(spark: SparkSession, bronze: str) -> DataFrame:
    """All landed archives."""
    path = posixpath.join(bronze, "_catalog")
    if not exists(spark, path):
        return spark.createDataFrame([], _LANDED)
    return spark.read.schema(_LANDED).parquet(path)


def _copy_task(bronze: str, packs: str):
    def run(batches):
        target_fs, root = open_fs(bronze)
        pack = _Pack(packs)
        for batch in batches:
            rows = [_copy(row, bronze, target_fs, root, pack) for row in batch.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=["user_id", "source", "length", "modified", "sha256", "archive"])
        pack.close()

    return run


def _copy(row, bronze: str, target_fs, root: str, pack: "_Pack"):
    source_fs, source_path = open_fs(row.source)
    with source_fs.open_input_stream(source_path) as src:
        blocks = iter(lambda: src.read(BLOCK), b"")
        head = _up_to(blocks, SMALL_BYTES)
        digest = hashlib.sha256(head)
        if len(head) <= SMALL_BYTES and zipfile.is_zipfile(io.BytesIO(head)):
            archive = pack.add(head, digest.hexdigest())
            return row.user_id, row.source, row.length, row.modified, digest.hexdigest(), archive
        folder = posixpath.join(root, quote(row.user_id, safe=""))
        target_fs.create_dir(folder, recursive=True)
        attempt = posixpath.join(folder, f".{uuid.uuid4().hex}.part")
        with target_fs.open_output_stream(attempt) as out:
            out.write(head)
            for block in blocks:
                digest.update(block)
                out.write(block)
    name = f"{digest.hexdigest()}.zip"
    target_fs.move(attempt, posixpath.join(folder, name))
    archive = posixpath.join(bronze, quote(row.user_id, safe=""), name)
    return row.user_id, row.source, row.length, row.modified, digest.hexdigest(), archive


class _Pack:
    """Archives one after another in a file, or several of about ``PACK_BYTES``; a file gets its name when it is whole."""

    def __init__(self, folder: str):
        self.folder, self.out = folder, None

    def add(self, content: bytes, digest: str) -> str:
        """Where the archive is: file, first byte, bytes and digest."""
        if self.out is None:
            self.files, root = open_fs(self.folder)
            self.files.create_dir(root, recursive=True)
            self.name = f"{uuid.uuid4().hex}.pack"
            self.path, self.attempt = posixpath.join(root, self.name), posixpath.join(root, f".{self.name}.part")
            self.out = self.files.open_output_stream(self.attempt, buffer_size=BLOCK)
        start = self.out.tell()
        self.out.write(content)
        place = f"{posixpath.join(self.folder, self.name)}#{start}+{len(content)}/{digest}.zip"
        if start + len(content) >= PACK_BYTES:
            self.close()
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.files.move(self.attempt, self.path)
            self.out = None


@contextmanager
def open_archive(place: str):
    """A landed archive as a file that can be read at any place."""
    packed = _PLACE.fullmatch(place)
    files, path = open_fs(packed[1] if packed else place)
    with files.open_input_file(path) as raw:
        if not packed:
            yield raw
            return
        content = raw.read_at(int(packed[3]), int(packed[2]))
    if len(content) < int(packed[3]):
        raise OSError(f"{place} is cut short")
    yield io.BytesIO(content)


class ExportError(ValueError):
    """An archive that is not a usable export."""


# What a bad archive raises, as opposed to storage that fails for the moment.
_BAD_ARCHIVE = (
    ExportError, zipfile.BadZipFile, zlib.error, EOFError, expat.ExpatError, RuntimeError, NotImplementedError,
    ArrowInvalid,  # seeking in a file shorter than an archive's directory
)


def unpack_exports(
    landed: DataFrame, staging: str, part_bytes: int = 64 << 20, set_aside: bool = False
) -> DataFrame:
    """Write each archive's export XML as documents of about ``part_bytes``.

    Every part is a whole document of its own (prolog, root element, some of
    the children), so one user's export is read by many tasks however large it
    is. Small parts are rows of a table under ``staging/packs``, beside where
    their elements stand, so many small exports make few files. Larger ones are
    files that carry user and digest in their names and lie in 256 folders.

    An archive that cannot be read, has unsafe member names, no export or XML
    that is not well-formed is an error. With ``set_aside`` it leaves no parts
    and gives one row with the reason, and the other archives go on. Returns
    one row per part.
    """
    spark = landed.sparkSession
    drop_shuffles(spark)
    packs = posixpath.join(staging, PACKS, f"run={uuid.uuid4().hex}")
    archives = landed.select("user_id", "sha256", "length", F.col("archive").alias("source"))
    parts = _spread(archives).mapInArrow(_unpack_task(staging, part_bytes, set_aside), PACKED)
    # A reader holds a row group's documents at a time.
    parts.write.option("parquet.block.size", ARCHIVE_BYTES).option("compression", "zstd").parquet(packs)
    return spark.read.schema(PACKED).parquet(packs).select(*[name.split()[0] for name in UNPACKED.split(", ")])


def _unpack_task(staging: str, part_bytes: int, set_aside: bool):
    def run(batches):
        rows, size = [], 0
        target_fs, root = open_fs(staging)
        for batch in batches:
            for row in batch.to_pandas().itertuples(index=False):
                folder = posixpath.join(root, row.sha256[:2])
                parts = []
                try:
                    for part in _unpack(row, target_fs, folder, part_bytes):
                        parts.append(part)
                except _BAD_ARCHIVE as error:
                    if not set_aside:
                        raise
                    for written in parts:
                        if written["document"] is None:
                            target_fs.delete_file(written["part"])
                    parts = [{"user_id": row.user_id, "sha256": row.sha256, "error": f"{type(error).__name__}: {error}"}]
                rows += parts
                size += sum(len(part.get("document") or b"") for part in parts)
                if size >= ARCHIVE_BYTES or len(rows) >= 4_096:
                    yield pa.RecordBatch.from_pylist(rows, _PACKED)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _PACKED)

    return run


def _unpack(row, target_fs, folder: str, part_bytes: int):
    kept = 0
    with open_archive(row.source) as raw, zipfile.ZipFile(raw) as archive:
        member = archive.getinfo(export_member(archive.namelist()))
        with archive.open(member) as xml:
            for number, blocks in enumerate(_parts(xml, member.file_size, part_bytes)):
                name = part_name(row.user_id, row.sha256, number)
                part = {"user_id": row.user_id, "sha256": row.sha256, "part": name, "error": None, "document": None}
                head = _up_to(blocks, PACKED_BYTES)
                # Two-byte characters are left to the reader of files.
                if len(head) <= PACKED_BYTES and kept + len(head) <= ARCHIVE_BYTES and not head.startswith(_TWO_BYTES):
                    kept += len(head)
                    yield part | {"bytes": len(head), "document": head} | element_spans(head)
                    continue
                path = posixpath.join(folder, name)
                attempt = posixpath.join(folder, f".{uuid.uuid4().hex}.part")
                target_fs.create_dir(folder, recursive=True)
                with target_fs.open_output_stream(attempt) as out:
                    out.write(head)
                    for block in blocks:
                        out.write(block)
                    size = out.tell()
                target_fs.move(attempt, path)
                yield part | {"part": path, "bytes": size}


def _parts(xml, size: int, part_bytes: int):
    """As ``split_document``; a small document is one part, which ``element_spans`` checks and need not be read for cuts."""
    if size > min(part_bytes, PACKED_BYTES):
        return split_document(xml, part_bytes)
    document = xml.read()
    if document.startswith(_TWO_BYTES):
        return split_document(io.BytesIO(document), part_bytes)
    return iter([iter([document])])


def _up_to(blocks, size: int) -> bytes:
    """The first blocks, until they are longer than ``size`` or used up."""
    head = bytearray()
    for block in blocks:
        head += block
        if len(head) > size:
            break
    return bytes(head)


def element_spans(document: bytes) -> dict[str, list[dict]]:
    """Per tag, start and length of its elements at any depth; of nested ones with the same tag the outermost."""
    spans, begun, open_now = {tag: [] for tag in TAGS}, {}, dict.fromkeys(TAGS, 0)
    parser = expat.ParserCreate()

    def start(name, attributes):
        if name in open_now:
            if not open_now[name]:
                begun[name] = parser.CurrentByteIndex
            open_now[name] += 1

    def end(name):
        if name in open_now:
            open_now[name] -= 1
            if not open_now[name]:
                # At an end tag the parser stands before it, at an empty element behind it.
                stop = parser.CurrentByteIndex
                if document.startswith(b"</" + name.encode(), stop):
                    stop = document.index(b">", stop) + 1
                spans[name].append({"start": begun[name], "length": stop - begun[name]})

    parser.StartElementHandler, parser.EndElementHandler = start, end
    parser.Parse(document, True)
    return spans


def part_name(user_id: str, sha256: str, number: int) -> str:
    """Name of a part; the user id is in hexadecimal, safe in any path."""
    return f"{user_id.encode().hex()}-{sha256}-{number:05d}.xml"


def export_member(names: list[str]) -> str:
    """The export among an archive's members; refuses names that leave the archive."""
    for name in names:
        clean = posixpath.normpath(name.replace("\\", "/"))
        if clean.startswith(("/", "../")) or clean == ".." or clean[1:2] == ":":
            raise ExportError(f"archive member outside its folder: {name}")
    exports = [n for n in names if posixpath.basename(n) == EXPORT_NAME]
    if not exports:
        raise ExportError(f"no {EXPORT_NAME} in the archive")
    return min(exports, key=lambda n: (n.count("/"), n))


def split_document(stream, part_bytes: int):
    """Cut an XML document between children of its root element.

    Yields, per part, an iterator of byte blocks that must be used up before
    the next part is asked for. Bytes are passed on unchanged: the opening of
    the document (up to the root's first child) leads every part, and each part
    but the last is closed by the root's end tag. Memory use is a few blocks.
    """
    cutter = _Cutter(stream, part_bytes)
    while not cutter.done:
        yield cutter.part()


class _Cutter:
    """Feeds blocks to expat, which reports where the root's children begin."""

    def __init__(self, stream, part_bytes: int):
        self.stream, self.part_bytes = stream, part_bytes
        self.parser = expat.ParserCreate()
        self.parser.StartElementHandler = self._start
        self.parser.EndElementHandler = self._end
        self.depth = 0
        self.root = None
        self.children = []       # offsets of root children not handed out yet
        self.pending = b""       # bytes read and not handed out
        self.offset = 0          # document offset of the first pending byte
        self.opening = None      # everything before the root's first child
        self.ended = False
        self.done = False

    def _start(self, name, attributes):
        if self.depth == 0:
            self.root = name
        elif self.depth == 1:
            self.children.append(self.parser.CurrentByteIndex)
        self.depth += 1

    def _end(self, name):
        self.depth -= 1

    def _read(self):
        block = self.stream.read(BLOCK)
        if block.startswith(_TWO_BYTES) and not self.offset and not self.pending:
            self.part_bytes = float("inf")  # two-byte characters: leave whole
        self.ended = not block
        self.parser.Parse(block, self.ended)
        self.pending += block

    def _hand_out(self, upto: int) -> bytes:
        size = max(0, upto - self.offset)
        out, self.pending = self.pending[:size], self.pending[size:]
        self.offset += size
        self.children = [c for c in self.children if c >= self.offset]
        return out

    def part(self):
        if self.opening is None:
            while not self.children and not self.ended:
                self._read()
            self.opening = self.pending[: self.children[0]] if self.children else b""
        else:
            yield self.opening
        begin = self.children[0] if self.children else self.offset
        while True:
            cut = next((c for c in self.children if c - begin >= self.part_bytes), None)
            if cut is not None:
                yield self._hand_out(cut)
                yield f"</{self.root}>\n".encode()
                return
            if self.ended:
                yield self._hand_out(self.offset + len(self.pending))
                self.done = True
                return
            # No later child can start before the parser's position.
            yield self._hand_out(self.parser.CurrentByteIndex)
            self._read()
