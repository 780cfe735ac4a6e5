"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

A text's set has its distinct shingles of five words; texts link when
``100 * |A & B| >= PERCENT * |A | B|``. No link is lost:

* Shingles are ordered by how crowded their bucket of ``2 ** LEVEL_BITS`` is
  (counted over all texts) and then by hash. Similar sets share one of their
  first ``|A| - ceil(PERCENT |A| / 100) + 1`` shingles in any common order, so
  sets meet at those, and crowded shingles hardly matter.
* Sets that meet at a shingle make a tile; a shingle of many sets is cut into
  tiles by size band and by blocks within it, so that a tile holds a bounded
  number, and only blocks of the same and of neighbouring bands are paired.
* In a tile, bits set in only one of two signatures bound the shared shingles
  from above. Pairs within the bound go on to the exact intersection of sorted
  arrays.

Equal sets are one node. Pairs within the bound only say which nodes belong
together: each node of a shingle is held against the one with the most company
there, shingles whose nodes are then together are done, and the others' tiles
add what is missing. Each such group is cut into tiles in the same way, and
there the pairs that no link connects yet meet exactly, once for all shingles
they share.
"""

from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from vitals.llm.common import mix64, partitions, plain_text, stored, summed_counts
from vitals.llm.components import components

SHINGLE = 5
PERCENT = 80
LEVEL_BITS = 18
TILE = 256
LEAST_BITS, MOST_BITS = 64, 16_384
#: Bits that say which hashes are on a list, in rows of so many.
LIST_BITS, ROW_BITS = 1 << 24, 1 << 15

_LONG_WORD = 64
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POWERS = np.cumprod(np.full(_LONG_WORD, 0xD1342543DE82EF95, np.uint64))
_WORDS_AT_ONCE = 1 << 16
_PLACES = mix64(np.arange(1, SHINGLE + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A hash of each word, computed for many words at a time."""
    out = []
    for at in range(0, len(words), _WORDS_AT_ONCE):
        part = words[at:at + _WORDS_AT_ONCE]
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        long = np.flatnonzero(sizes > _LONG_WORD).tolist()
        if long:
            part = [w[:1] if len(w) > _LONG_WORD else w for w in part]
            sizes = np.fromiter(map(len, part), np.int64, len(part))
        starts = np.cumsum(sizes) - sizes
        letters = np.frombuffer(b"".join(part), np.uint8)
        place = np.arange(len(letters)) - np.repeat(starts, sizes)
        hashes = mix64(np.add.reduceat(_BYTES[letters] * _POWERS[place], starts))
        for i in long:
            hashes[i] = xxhash.xxh64_intdigest(words[at + i])
        out.append(hashes)
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_set(text: str) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of fewer words, of all of them."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    hashes, n = word_hashes(words), min(SHINGLE, len(words))
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total += hashes[i:len(words) - n + 1 + i] * _PLACES[i]
    return np.unique(mix64(total))


def least_shared(a, b, percent: int):
    """Shingles that sets of these sizes must share to link."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(size: int, percent: int) -> int:
    return size + (-percent * size // 100) + 1 if size else 0


def signature_bits(size: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << (size - 1).bit_length()))


def signature(hashes: np.ndarray, more: int = 1) -> bytes:
    """A bit for each shingle among as many as the size asks for, or ``more`` times as many."""
    width = signature_bits(len(hashes)) * more
    bits = np.zeros(width, bool)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(signature: bytes, width: int) -> np.ndarray:
    """The signature as it would be in fewer bits."""
    return np.bitwise_or.reduce(np.frombuffer(signature, np.uint64).reshape(-1, width // 64), axis=0)


def size_band(size, percent: int):
    """Sets that can link are in the same or in neighbouring bands."""
    return np.floor(np.log(size) / _band_width(percent)).astype(np.int64)


def _band_width(percent: int) -> float:
    return max(1e-3, -log(percent / 100) * (1 + 1e-6))


def near_by_signature(sizes, signatures, percent: int, more: int = 1):
    """Places ``i, j`` of all sets that may link; by bands of size."""
    sizes = np.asarray(sizes, np.int64)
    order = np.argsort(sizes, kind="stable")
    bands = size_band(sizes[order], percent)
    for band in np.unique(bands).tolist():
        low, middle, high = np.searchsorted(bands, [band, band + 1, band + 2])
        ours, all_of = order[low:middle], order[low:high]
        width = signature_bits(int(sizes[ours[0]])) * more
        bits = np.stack([folded(signatures[i], width) for i in all_of.tolist()])
        apart = np.zeros((len(ours), len(all_of)), np.int64)
        for word in range(bits.shape[1]):
            apart += np.bitwise_count(bits[:len(ours), word, None] ^ bits[None, :, word])
        total = sizes[ours][:, None] + sizes[all_of]
        bound = np.minimum((total - apart) // 2, sizes[ours][:, None])
        near = (bound >= least_shared(sizes[ours][:, None], sizes[all_of], percent)) & (np.arange(len(ours))[:, None] < np.arange(len(all_of)))
        i, j = np.nonzero(near)
        yield ours[i], all_of[j]


def few_near_by_signature(sizes, signatures, percent: int):
    """The same for a few sets, with signatures as whole numbers."""
    order = sorted(range(len(sizes)), key=sizes.__getitem__)
    numbers = {}

    def number(i, width):
        if (i, width) not in numbers:
            numbers[i, width] = int.from_bytes(folded(signatures[i], width).tobytes(), "little")
        return numbers[i, width]

    for at, i in enumerate(order):
        width = signature_bits(sizes[i])
        for j in order[at + 1:]:
            if 100 * sizes[i] < percent * sizes[j]:
                break
            total = sizes[i] + sizes[j]
            if (total - (number(i, width) ^ number(j, width)).bit_count()) // 2 >= least_shared(sizes[i], sizes[j], percent):
                yield i, j


def crowded(texts: DataFrame) -> np.ndarray:
    """A level for each bucket of shingles: 0 up to twice the mean count, then one more per doubling, at most 15."""
    def counter():
        def add(total, batch):
            for t in batch.column(0):
                np.add.at(total, (shingle_set(t.as_py()) >> np.uint64(64 - LEVEL_BITS)).astype(np.int64), 1)
        return add

    counts = summed_counts(texts.select("text"), counter, 1 << LEVEL_BITS)
    return np.clip(np.floor(np.log2(np.maximum(counts, 1) / max(counts.mean(), 1))), 0, 15).astype(np.uint8)


def described(docs: DataFrame, doc_id, text, percent: int) -> DataFrame:
    """Stored rows: ``row, doc_id, digest`` (of the text), ``n_shingles, content`` (of the set), ``prefix, bits``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), plain_text(F.col(text)).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(crowded(rows))
    kind = pa.struct([("n", pa.int64()), ("content", pa.binary()), ("prefix", pa.list_(pa.int64())), ("bits", pa.binary())])

    @F.arrow_udf("struct<n:bigint,content:binary,prefix:array<bigint>,bits:binary>")
    def describe(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            own = shingle_set(t.as_py())
            level = shared.value[(own >> np.uint64(64 - LEVEL_BITS)).astype(np.int64)].astype(np.uint64)
            keys = (level << np.uint64(59)) | (own >> np.uint64(5))
            size = prefix_size(len(own), percent)
            first = np.sort(np.partition(keys, size - 1)[:size]) if size else keys
            out.append({"n": len(own), "content": xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None,
                        "prefix": first.astype(np.int64), "bits": signature(own) if len(own) else None})
        return pa.array(out, kind)

    rows = rows.select("doc_id", F.unhex(F.md5("text")).alias("digest"), describe("text").alias("s"))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "digest", F.col("s.n").alias("n_shingles"),
                              "s.content", "s.prefix", "s.bits"), "join-rows")


def listed_bits(hashes: DataFrame) -> DataFrame:
    """Stored ``bits_row, bits_set``: a bit for each ``hash`` of a list, at most ``LIST_BITS`` of them however long the list."""
    place = F.pmod(F.col("hash"), F.lit(LIST_BITS))
    placed = hashes.select(F.floor(place / ROW_BITS).alias("bits_row"), (place % ROW_BITS).alias("at"))
    placed = placed.repartition(partitions(hashes.sparkSession), "bits_row")  # else every task would send a row of bits per row
    return stored(placed.groupBy("bits_row").agg(F.bitmap_construct_agg("at").alias("bits_set")), "join-listed")


def may_be_listed(rows: DataFrame, hash: Column, bits: DataFrame) -> DataFrame:
    """``rows`` with ``listed``: true wherever the list has the hash, false for nearly all others while it has fewer hashes than bits."""
    place = F.pmod(hash, F.lit(LIST_BITS))
    rows = rows.join(F.broadcast(bits), F.floor(place / ROW_BITS) == F.col("bits_row"), "left")
    at = place % ROW_BITS
    byte = F.conv(F.hex(F.substring("bits_set", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return rows.withColumn("listed", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("bits_row", "bits_set")


def texts_of(nodes: DataFrame, docs: DataFrame, doc_id, text) -> DataFrame:
    """Stored ``node, text`` of ``node, doc_id, digest`` rows; of the texts that are not needed few are moved."""
    nodes = stored(nodes.select("node", "doc_id", "digest"), "join-needed")
    texts = docs.select(F.col(doc_id).alias("id"), plain_text(F.col(text)).alias("text")).withColumn("d", F.unhex(F.md5("text")))
    texts = may_be_listed(texts, F.xxhash64("d"), listed_bits(nodes.select(F.xxhash64("digest").alias("hash")))).filter("listed")
    texts = texts.join(nodes, (F.col("d") == F.col("digest")) & F.col("id").eqNullSafe(F.col("doc_id"))).select("node", "text")
    texts = stored(texts, "join-texts")
    # Only rows that repeat both id and text are there twice.
    if not texts.groupBy("node").count().filter("count > 1").isEmpty():
        texts = stored(texts.dropDuplicates(["node"]), "join-texts")
    return texts


def _links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def linked_pairs(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of pairs ``a, b`` of nodes those that link."""
    @F.arrow_udf("boolean")
    def links(a: pa.Array, text_a: pa.Array, text_b: pa.Array) -> pa.Array:
        last, own, out = None, None, []
        for name, one, other in zip(a.to_pylist(), text_a, text_b):
            if name != last:
                last, own = name, shingle_set(one.as_py())
            out.append(_links(own, shingle_set(other.as_py()), percent))
        return pa.array(out, pa.bool_())

    rows = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    rows = rows.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").sortWithinPartitions("a")
    return stored(rows.filter(links("a", "text_a", "text_b")).select("a", "b"), "join-links")


def tiles(members: DataFrame, percent: int) -> DataFrame:
    """``tile, side, node, size, root`` of ``key, node, size, root, n`` rows: every pair of a key with different roots and fitting sizes is in a tile."""
    small = members.filter(F.col("n") <= TILE).select(F.col("key").cast("string").alias("tile"), F.lit(0).alias("side"), "node", "size", "root")
    many = members.filter(F.col("n") > TILE).withColumn("band", F.floor(F.log("size") / F.lit(_band_width(percent))))
    half = TILE // 2
    parts = many.groupBy("key", "band").agg(F.ceil(F.count("*") / half).alias("parts"))
    many = many.join(parts, ["key", "band"]).withColumn("part", F.pmod(F.xxhash64("node", "key"), F.col("parts")))
    there = many.groupBy("key", "band", "part").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    there = stored(there.withColumn("name", F.struct("band", "part")), "join-blocks")
    other = there.select("key", *[F.col(c).alias(f"{c}_b") for c in ("band", "least", "most", "name")])
    paired = there.join(other, "key").filter("name <= name_b AND band_b - band <= 1")
    paired = paired.filter("least <> most OR least_b <> most_b OR least <> least_b")  # not all of one root
    tile = F.concat_ws(":", "key", "name.band", "name.part", "name_b.band", "name_b.part")
    paired = paired.select("key", tile.alias("tile"), "name", "name_b")
    sides = paired.select("key", "tile", F.lit(0).alias("side"), "name").unionByName(
        paired.filter("name <> name_b").select("key", "tile", F.lit(1).alias("side"), F.col("name_b").alias("name")))
    large = many.withColumn("name", F.struct("band", "part")).join(sides, ["key", "name"])
    return small.unionByName(large.select("tile", "side", "node", "size", "root"))


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class _Together:
    """Places of a tile that are connected."""

    def __init__(self, roots):
        first = {}
        self.above = [first.setdefault(root, i) for i, root in enumerate(roots)]

    def find(self, i):
        while self.above[i] != i:
            self.above[i] = i = self.above[self.above[i]]
        return i

    def join(self, i, j):
        self.above[self.find(j)] = self.find(i)


def _by_tile(rows: DataFrame, columns, pairs_of) -> DataFrame:
    """Pairs ``a, b`` that ``pairs_of`` finds among the rows of each tile, a bounded number."""
    def found(batches):
        tile, members = None, []
        for batch in batches:
            out = []
            for name, *row in zip(*(batch.column(i).to_pylist() for i in range(len(columns) + 1))):
                if name != tile:
                    if len(members) > 1:
                        out += pairs_of(*zip(*members))
                    tile, members = name, []
                members.append(row)
            yield _batch(out)
        yield _batch(list(pairs_of(*zip(*members))) if len(members) > 1 else [])

    def _batch(out):
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], schema=_PAIR)

    dealt = rows.select("tile", *columns).repartition(partitions(rows.sparkSession), "tile")
    return dealt.sortWithinPartitions("tile").mapInArrow(found, "a long, b long")


def candidates(tiled: DataFrame, percent: int) -> DataFrame:
    """Pairs that connect all nodes of a tile which the signatures allow to link; of each tile fewer than it has nodes."""
    def pairs_of(sides, nodes, sizes, roots, signatures):
        together, across = _Together(roots), len(set(sides)) > 1
        if len(nodes) <= 24:
            near = few_near_by_signature(sizes, signatures, percent)
        else:
            near = (p for i, j in near_by_signature(sizes, signatures, percent) for p in zip(i.tolist(), j.tolist()))
        for i, j in near:
            if not (across and sides[i] == sides[j]) and together.find(i) != together.find(j):
                together.join(i, j)
                yield nodes[i], nodes[j]

    return stored(_by_tile(tiled, ["side", "node", "size", "root", "bits"], pairs_of).distinct(), "join-pairs")


def links_in_tiles(tiled: DataFrame, percent: int) -> DataFrame:
    """Links of ``tile, side, node, root, text`` rows that connect what is linked and has different roots."""
    more = 4

    def pairs_of(sides, nodes, roots, texts):
        if len(set(roots)) == 1:
            return
        sets, together, across = [shingle_set(t) for t in texts], _Together(roots), len(set(sides)) > 1
        signatures = [signature(s, more) for s in sets]
        for i, j in near_by_signature([len(s) for s in sets], signatures, percent, more):
            for i, j in zip(i.tolist(), j.tolist()):
                if not (across and sides[i] == sides[j]) and together.find(i) != together.find(j) and _links(sets[i], sets[j], percent):
                    together.join(i, j)
                    yield nodes[i], nodes[j]

    return stored(_by_tile(tiled, ["side", "node", "root", "text"], pairs_of), "join-links")


def _grouped(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """``members`` with ``root``, the least node of the component of the pairs."""
    roots = components(pairs).withColumnRenamed("node", "name")
    rows = members.join(roots, F.col("node") == F.col("name"), "left")
    return rows.withColumn("root", F.coalesce("root", "node")).drop("name")


def _apart(members: DataFrame) -> DataFrame:
    """``key, node, size, root, n`` of the keys with several roots; of keys with the same nodes only one."""
    keys = members.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most"),
                                      F.bit_xor(F.xxhash64("node")).alias("one"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("other"))
    keys = keys.filter("least <> most").groupBy("n", "one", "other").agg(F.min("key").alias("key")).select("key", "n")
    return stored(members.join(keys, "key"), "join-mixed")


def node_links(nodes: DataFrame, rows: DataFrame, docs: DataFrame, doc_id, text, percent: int) -> DataFrame:
    """Links ``a, b`` that connect every two nodes connected by any links; ``rows`` has the nodes and may have more."""
    keyed = nodes.select(F.explode("prefix").alias("key"), F.col("row").alias("node"), F.col("n_shingles").cast("int").alias("size"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(keyed.join(shared.select("key"), "key"), "join-members")
    company = stored(members.groupBy("node").agg((F.count("*") / F.first("size")).alias("company")), "join-company")
    leader = F.max_by(F.struct("node", "size"), F.struct("company", "node")).alias("leader")
    led = members.join(company, "node").groupBy("key").agg(leader)
    pairs = members.join(led, "key").filter("node <> leader.node").filter(
        100 * F.least("size", "leader.size") >= percent * F.greatest("size", "leader.size"))
    pairs = pairs.select(F.col("leader.node").alias("a"), F.col("node").alias("b")).distinct()
    near = stored(_within_bound(pairs, rows, percent), "join-pairs")

    apart = _apart(stored(_grouped(members, near), "join-rooted"))
    bits = rows.select(F.col("row").alias("node"), "bits")
    near = near.unionByName(candidates(tiles(apart, percent).join(bits, "node"), percent))

    groups = components(near).withColumnRenamed("root", "key")
    sizes = groups.groupBy("key").agg(F.count("*").alias("n"))
    named = rows.select(F.col("row").alias("node"), F.col("n_shingles").cast("int").alias("size"), "doc_id", "digest")
    groups = stored(groups.join(sizes, "key").join(named, "node"), "join-groups")
    texts = texts_of(groups, docs, doc_id, text)
    groups = groups.drop("doc_id", "digest")
    large = groups.filter(F.col("n") > TILE)
    hubs = large.join(company, "node").groupBy("key").agg(F.max_by("node", F.struct("company", "node")).alias("a"))
    links = linked_pairs(large.join(hubs, "key").filter("a <> node").select("a", F.col("node").alias("b")), texts, percent)
    tiled = tiles(stored(_grouped(groups, links), "join-rooted"), percent).join(texts, "node")
    return links.unionByName(links_in_tiles(tiled, percent))


def first_rows(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``row, n_shingles, prefix`` of the rows that stand for their set; only those that may be copies of others are moved."""
    copies = rows.filter("content IS NOT NULL").select("row", "content").join(sets.select("content", "node"), "content").filter("row <> node")
    copies = stored(copies.select("row"), "join-copies")
    found = may_be_listed(rows.filter("content IS NOT NULL").select("row", "n_shingles", "prefix"), F.xxhash64("row"), listed_bits(copies.select(F.xxhash64("row").alias("hash"))))
    return found.filter("NOT listed").unionByName(found.filter("listed").join(copies, "row", "left_anti")).drop("listed")


def _within_bound(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs that their signatures allow."""
    @F.arrow_udf("boolean")
    def allowed(size_a: pa.Array, bits_a: pa.Array, size_b: pa.Array, bits_b: pa.Array) -> pa.Array:
        out = []
        for a, one, b, other in zip(*(c.to_pylist() for c in (size_a, bits_a, size_b, bits_b))):
            width = min(len(one), len(other)) * 8
            apart = int(np.bitwise_count(folded(one, width) ^ folded(other, width)).sum())
            out.append((a + b - apart) // 2 >= least_shared(a, b, percent))
        return pa.array(out, pa.bool_())

    def side(name):
        return nodes.select(F.col("row").alias(name), F.col("n_shingles").alias(f"size_{name}"), F.col("bits").alias(f"bits_{name}"))

    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    return rows.filter(allowed("size_a", "bits_a", "size_b", "bits_b")).select("a", "b")


def joined(docs: DataFrame, doc_id="doc_id", text="text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``row`` (a number of its own), ``doc_id``, ``n_shingles``, ``component_id``.

    ``component_id`` is the least id reachable by links, its own included. Null
    and empty texts, and texts without words, have no shingles and are linked
    with nothing, not even with each other. Rows that repeat an id are rows of
    their own; a null id counts only where a component has no other (then it
    is null). Texts of any length are read whole; other columns are not looked
    at; an empty table gives no rows.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be over 0 and at most 100")
    rows = described(docs, doc_id, text, percent)
    sets = rows.filter("content IS NOT NULL").groupBy("content").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"))
    sets = stored(sets, "join-sets")
    nodes = first_rows(rows, sets)
    roots = components(node_links(nodes, rows, docs, doc_id, text, percent))
    sets = sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(sets.join(ids, "root").select("content", "component_id"), "join-components")
    rows = rows.select("row", "doc_id", "n_shingles", "content").join(named.withColumn("set", F.lit(True)), "content", "left")
    return rows.select("row", "doc_id", "n_shingles", F.when(F.col("set"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
