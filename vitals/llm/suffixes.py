"""Removal of repeated byte strings by sorting suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
somewhere else. Sorting the suffixes of every byte would move hundreds of bytes
per byte, so suffixes are first grouped by content: a string's anchor is its
leftmost stretch of ``GRAM`` bytes with the least hash. Equal strings have
equal anchors at the same place, so only strings whose anchor recurs can
recur. Neighbouring strings with the same anchor form one run, about one per
70 bytes of text.

* Runs whose anchor occurs once are done: nothing in them recurs.
* Runs equal to another run as a whole recur as a whole.
* What is left is sorted: one copy of each distinct run whose anchor has
  others goes, by sampled splitters over the anchor's leading bytes, to a range
  partition. There all strings of the runs are sorted by multikey quicksort,
  eight bytes to a key, and equal neighbours recur. Splitters never part equal
  leading bytes, so no pair straddles a boundary.
* An anchor with over ``CROWD`` distinct runs (a line in a third of all
  documents, say) would fill one bucket. Its strings are counted by 128-bit
  hash instead, with map-side partial counts.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vitals.llm.common import mix64, partitions, stored

LENGTH = 200
GRAM = 32
#: Distinct runs of one anchor that one task sorts: some 4 MB of bytes, a million strings, about 100 MB of sort keys.
CROWD = 16_384
SEGMENT = 1 << 22
BUCKET_RUNS = 8_192

_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_FOLD = mix64(np.arange(1000, 1006, dtype=np.uint64)) | np.uint64(1)
_PLACE = np.uint64(0xFFFFFF)


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of every ``size`` bytes (a power of two), by doubling."""
    hashes, width, step = _BYTE[data], 1, 0
    while width < size:
        hashes = hashes[:-width] * _FOLD[step] + hashes[width:]
        hashes ^= hashes >> np.uint64(29)
        width, step = width * 2, step + 1
    return hashes * np.uint64(0x94D049BB133111EB)


def runs(data: np.ndarray):
    """Anchor hashes, anchor positions, first string and number of strings of each run, in order."""
    count = len(data) - LENGTH + 1
    hashes = gram_hashes(data)
    width = LENGTH - GRAM + 1
    keys = hashes & ~_PLACE | np.arange(len(hashes), dtype=np.uint64)  # the position makes the leftmost of equals least
    padded = np.full(-(-len(keys) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    anchor = (np.minimum(behind[:count], ahead[width - 1:width - 1 + count]) & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    return hashes[anchor[first]].view(np.int64), anchor[first], first, np.diff(np.append(first, count))


def text_runs(text: bytes):
    """``(anchors, wholes, places)``: per run the anchor's hash, the whole run's hash, and first string * 65536 + anchor's place * 256 + strings.

    Longer texts are worked on in overlapping segments, which only cuts runs.
    """
    out = [[], [], []]
    view = memoryview(text)
    for low in range(0, max(len(text) - LENGTH + 1, 0), SEGMENT):
        part = view[low:low + SEGMENT + LENGTH - 1]
        anchors, anchor_at, first, strings = runs(np.frombuffer(part, np.uint8))
        out[0].append(anchors)
        out[1].append(np.array([
            xxhash.xxh3_64_intdigest(part[a:a + n + LENGTH - 1]) for a, n in zip(first.tolist(), strings.tolist())], np.uint64).view(np.int64))
        out[2].append((first + low) * 65536 + (anchor_at - first) * 256 + strings)
    return [np.concatenate(o) if o else np.empty(0, np.int64) for o in out]


def spread(docs: DataFrame, text: str, keep) -> DataFrame:
    """Stored documents: number ``row``, struct ``kept``, squeezed text ``z``, and their runs as arrays."""
    def read(batches):
        import zstandard
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            columns = [[], [], [], []]
            for value in batch.column(2):
                data = value.as_py() or b""
                columns[0].append(squeeze(data))
                for column, found in zip(columns[1:], text_runs(data)):
                    column.append(found)
            arrays = [pa.array(columns[0], pa.binary())] + [pa.array(c, pa.list_(pa.int64())) for c in columns[1:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["row", "kept", "z", "anchors", "wholes", "places"])

    kept = F.struct(*[F.col(c) for c in keep])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), kept.alias("kept"), F.col(text).cast("string").cast("binary").alias("text"))
    kind = rows.schema["kept"].dataType.simpleString()
    return stored(rows.mapInArrow(read, f"row long, kept {kind}, z binary, anchors array<bigint>, wholes array<bigint>, places array<bigint>"), "suffix-texts")


def equal_neighbours(buffer: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which strings of ``length`` bytes equal another of their group.

    Multikey quicksort on keys of eight bytes: strings are sorted by their
    next key within what the keys before left together, and strings alone drop
    out.
    """
    equal = np.zeros(len(starts), bool)
    active = np.arange(len(starts))
    groups = group
    keys = np.lib.stride_tricks.sliding_window_view(buffer, 8)
    for depth in range(0, length, 8):
        order = np.argsort(groups, kind="stable")
        active, groups = active[order], groups[order]
        alone = np.ones(len(active), bool)
        if len(active):
            same = groups[1:] == groups[:-1]
            alone[1:] &= ~same
            alone[:-1] &= ~same
        active, groups = active[~alone], groups[~alone]
        if not len(active):
            return equal
        key = np.ascontiguousarray(keys[starts[active] + min(depth, length - 8)]).view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((key, groups))
        active, groups, key = active[order], groups[order], key[order]
        changed = np.ones(len(active), bool)
        changed[1:] = (groups[1:] != groups[:-1]) | (key[1:] != key[:-1])
        groups = np.cumsum(changed)
    count = np.bincount(groups)
    equal[active] = count[groups] > 1
    return equal


def recurring(runs_of_bucket: list[tuple]) -> list[tuple]:
    """For ``(anchor, whole, place of the anchor, string)`` rows: ``(anchor, whole, covers)``, covers as bounds lo, hi in turn."""
    lengths = np.array([len(r[3]) for r in runs_of_bucket])
    strings = lengths - LENGTH + 1
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    buffer = np.frombuffer(b"".join(r[3] for r in runs_of_bucket), np.uint8)
    owner = np.repeat(np.arange(len(strings)), strings)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
    # equal strings have their anchor at the same place, so that and the anchor part them from the start
    _, anchor = np.unique([r[0] for r in runs_of_bucket], return_inverse=True)
    place = np.array([r[2] for r in runs_of_bucket])
    group = anchor[owner] * 1024 + (place[owner] - at)
    equal = equal_neighbours(buffer, offsets[owner] + at, group)
    out = []
    owner, at = owner[equal], at[equal]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)])) if len(owner) else []
    last = np.append(first[1:], len(owner)) - 1 if len(owner) else []
    found: dict[int, list[int]] = {}
    for a, b in zip(first, last):
        found.setdefault(int(owner[a]), []).extend((int(at[a]), int(at[b]) + LENGTH))
    for i, covers in found.items():
        out.append((runs_of_bucket[i][0], runs_of_bucket[i][1], covers))
    return out


_COVERS = pa.schema([("anchor", pa.int64()), ("whole", pa.int64()), ("covers", pa.list_(pa.int32()))])


def sort_buckets(batches):
    """Rows (lead, anchor, whole, place, string), sorted by lead and anchor, to what recurs within each anchor."""
    pending, current = [], None

    def flush():
        found = recurring(pending) if len(pending) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], _COVERS.field(i).type) for i in range(3)], schema=_COVERS)

    for batch in batches:
        for anchor, whole, place, string in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
            if anchor != current and len(pending) >= BUCKET_RUNS:
                yield flush()
                pending = []
            current = anchor
            pending.append((anchor, whole, place, string))
    yield flush()


def deduplicated(docs: DataFrame, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """One row per row: struct ``kept`` of the ``keep`` columns, ``n_bytes``, ``removed`` spans (start, end) and ``rest``, the bytes left.

    Texts are taken as UTF-8 bytes, null as empty; what is left need not be
    valid UTF-8. Texts under ``LENGTH`` bytes stay as they are. Rows that
    repeat a text, or an id, are places of their own. An empty table gives no
    rows. Columns beside ``keep`` are left out.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    texts = spread(docs, text, keep)
    every = texts.select("row", F.explode(F.arrays_zip("anchors", "wholes", "places")).alias("r")).select(
        "row", F.col("r.anchors").alias("anchor"), F.col("r.wholes").alias("whole"), F.col("r.places").alias("place"))
    again = every.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    every = stored(every.join(again, "anchor"), "suffix-runs")

    distinct = every.groupBy("anchor", "whole").agg(F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("at"))
    distinct = stored(distinct, "suffix-distinct")
    crowd = distinct.groupBy("anchor").agg(F.count("*").alias("distinct")).filter(F.col("distinct") > 1)
    unsure = distinct.join(crowd, "anchor").select(
        "anchor", "whole", F.col("at.row").alias("row"), F.col("at.place").alias("place"), (F.col("distinct") > CROWD).alias("crowded"))
    unsure = unsure.groupBy("row").agg(F.collect_list(F.struct("anchor", "whole", "place", "crowded")).alias("runs"))
    strings = unsure.join(texts.select("row", "z"), "row").select("z", "runs")

    def cut(batches):
        import zstandard
        opened = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for z, wanted in zip(batch.column(0), batch.column(1)):
                data, out = opened(z.as_py()), [[], [], [], [], [], []]
                for run in wanted.as_py():
                    low, place, strings = run["place"] >> 16, run["place"] >> 8 & 255, run["place"] & 255
                    string = data[low:low + strings + LENGTH - 1]
                    values = (int.from_bytes(string[place:place + 8], "big", signed=True), run["anchor"], run["whole"], place, string, run["crowded"])
                    for column, value in zip(out, values):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([
                    *[pa.array(out[i], pa.int64()) for i in range(3)], pa.array(out[3], pa.int32()), pa.array(out[4], pa.binary()),
                    pa.array(out[5], pa.bool_())], names=["lead", "anchor", "whole", "place", "string", "crowded"])

    strings = stored(strings.mapInArrow(cut, "lead long, anchor long, whole long, place int, string binary, crowded boolean"), "suffix-strings")
    buckets = strings.filter(~F.col("crowded")).select("lead", "anchor", "whole", "place", "string")
    buckets = buckets.repartitionByRange(n, "lead", "anchor").sortWithinPartitions("lead", "anchor", "whole")
    sorted_out = buckets.mapInArrow(sort_buckets, "anchor long, whole long, covers array<int>")

    def windows(batches):
        for batch in batches:
            for anchor, whole, string in zip(*(batch.column(i).to_pylist() for i in range(3))):
                count = len(string) - LENGTH + 1
                view = memoryview(string)
                yield pa.RecordBatch.from_pydict({
                    "hash": pa.array([xxhash.xxh3_128_digest(view[i:i + LENGTH]) for i in range(count)], pa.binary()),
                    "anchor": pa.array([anchor] * count, pa.int64()), "whole": pa.array([whole] * count, pa.int64()),
                    "at": pa.array(range(count), pa.int32())})

    counted = strings.filter("crowded").select("anchor", "whole", "string").mapInArrow(windows, "hash binary, anchor long, whole long, at int")
    common = counted.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    counted = counted.join(common, "hash").groupBy("anchor", "whole").agg(
        F.flatten(F.collect_list(F.array(F.col("at"), F.col("at") + LENGTH))).alias("covers"))

    twins = distinct.filter("n > 1").select(
        "anchor", "whole", F.array(F.lit(0), (F.col("at.place") % 256).cast("int") + LENGTH - 1).alias("covers"))
    covers = twins.unionByName(sorted_out).unionByName(counted)
    found = every.join(covers, ["anchor", "whole"]).select("row", F.struct(F.shiftright("place", 16).alias("first"), "covers").alias("c"))
    found = found.groupBy("row").agg(F.collect_list("c").alias("covers"))
    rows = texts.select("row", "kept", "z").join(found, "row", "left").select("kept", "z", "covers")
    kind = rows.schema["kept"].dataType.simpleString()

    def remove(batches):
        import zstandard
        opened = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sizes, spans, rest = [], [], []
            for z, own in zip(batch.column(1), batch.column(2)):
                data, own = opened(z.as_py()), own.as_py() or []
                bounds = sorted((c["first"] + lo, c["first"] + hi) for c in own for lo, hi in zip(c["covers"][::2], c["covers"][1::2]))
                gone: list[list[int]] = []
                for lo, hi in bounds:
                    if gone and lo <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], hi)
                    else:
                        gone.append([lo, hi])
                left, at = [], 0
                for lo, hi in gone:
                    left.append(data[at:lo])
                    at = hi
                left.append(data[at:])
                sizes.append(len(data))
                spans.append([{"start": lo, "end": hi} for lo, hi in gone])
                rest.append(b"".join(left))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(rest, pa.binary())], names=["kept", "n_bytes", "removed", "rest"])

    return rows.mapInArrow(remove, f"kept {kind}, n_bytes long, removed array<struct<start:bigint,end:bigint>>, rest binary")

