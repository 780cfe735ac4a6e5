"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A shingle of five words weighs its count in the text times its inverse
document frequency, the mean over its words of ``1 + DAMP ln((1+N)/(1+df)) /
ln(1+N)``: rare words count more, but so little more that a text with a few
words exchanged stays as similar as its share of kept shingles says. Document frequencies are counted over all documents in ``2 ** BITS``
buckets of words, a vector of fixed size. Consistent weighted sampling draws
``BANDS * ROWS`` shingles per text so that two texts draw the same with a
chance equal to their weighted Jaccard similarity; texts that agree on a whole
band are candidates, and candidates are verified by that similarity itself.

Equal texts count as one node. Candidates join into blocks (components of the
unverified links). A block of up to ``BLOCK_NODES`` texts meets in one task and
all its candidate pairs not yet connected are verified. In larger blocks the
same is done per band, and where more texts share a band, in random parts of
it; then the texts with most links there are compared with all others, and what
is left unconnected is verified pair by pair in tiles of two bounded parts.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vitals.llm.common import mix64, ngram_hashes, partitions, plain_text, stored, summed_counts, text_hashes
from vitals.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 3
BITS = 18
DAMP = 0.25
BLOCK_NODES = 256
LEADERS = 4

_STEP = 4096
_ODD = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _gamma_table() -> np.ndarray:
    """Quantiles of the gamma distribution with shape 2, at 65 536 even steps."""
    x = np.concatenate([[0.0], np.geomspace(1e-4, 40, 40_000)])
    return np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), 1 - (1 + x) * np.exp(-x), x)


_R = _gamma_table().astype(np.float32)
_INVERSE_R = 1 / _R
_LOG_C = np.log(_R)


def shingles(hashes: np.ndarray, idf: np.ndarray):
    """Distinct shingle hashes, sorted, and their weights, from word hashes; a shorter text is one shingle."""
    if not len(hashes):
        return np.empty(0, np.uint64), np.empty(0)
    rare = idf[(hashes >> np.uint64(64 - BITS)).astype(np.int64)]
    n = min(SHINGLE, len(hashes))
    grams = ngram_hashes(hashes, n)
    sums = np.concatenate([[0.0], np.cumsum(rare)])
    mean = np.round((sums[n:] - sums[:-n]) / n, 6)  # the same in every text
    unique, first, count = np.unique(grams, return_index=True, return_counts=True)
    return unique, count * mean[first]


def signature(grams: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A hash per sample: the drawn shingle and its level."""
    best = np.full(len(_ODD), np.inf, np.float32)
    drawn = np.zeros(len(_ODD), np.uint64)
    for low in range(0, len(grams), _STEP):
        part, logs = grams[low:low + _STEP], np.log(weights[low:low + _STEP]).astype(np.float32)
        mixed = part * _ODD[:, None]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x94D049BB133111EB)
        lanes = mixed.view(np.uint16).reshape(*mixed.shape, 4)  # four uniform numbers of 16 bits
        which = lanes[..., 3].astype(np.int64)
        beta = lanes[..., 2].astype(np.float32)
        beta += np.float32(0.5)
        beta *= np.float32(1 / 65536)
        level = _INVERSE_R.take(which)
        level *= logs
        level += beta
        np.floor(level, out=level)
        np.subtract(level, beta, out=beta)
        beta += np.float32(1)
        beta *= _R.take(which)
        value = _LOG_C.take(lanes[..., 1].astype(np.int64))
        value -= beta
        at = value.argmin(1)
        rows = np.arange(len(_ODD))
        found = value[rows, at]
        better = found < best
        best[better] = found[better]
        drawn[better] = mix64(part[at] ^ mix64(level[rows, at].astype(np.int64).view(np.uint64)))[better]
    return drawn


def bands(grams: np.ndarray, weights: np.ndarray) -> list[int]:
    if not len(grams):
        return []
    drawn = signature(grams, weights).reshape(BANDS, ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in range(ROWS):
        total = mix64(total ^ drawn[:, row])
    return total.view(np.int64).tolist()


def similarity(a, b) -> float:
    """Weighted Jaccard of two (sorted hashes, weights)."""
    _, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][in_a], b[1][in_b]).sum()
    total = a[1].sum() + b[1].sum() - shared
    return shared / total if total else 0.0


def inverse_frequencies(docs: DataFrame, text="text") -> np.ndarray:
    texts = docs.select(plain_text(text).alias("text"))

    def counter():
        def add(total, batch):
            for t in batch.column(0):
                total[(text_hashes(t.as_py()) >> np.uint64(64 - BITS)).astype(np.int64)] += 1  # once per bucket
            total[-1] += batch.num_rows
        return add

    counts = summed_counts(texts, counter, (1 << BITS) + 1)
    n = max(int(counts[-1]), 1)
    return 1 + DAMP * np.log((1 + n) / (1 + np.minimum(counts[:-1], n))) / np.log(1 + n)


def signed(docs: DataFrame, idf: np.ndarray, text="text") -> DataFrame:
    """Stored rows: number ``row``, the whole row as ``doc``, ``content`` (hash of the words), ``bands`` and ``weight`` of all shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    kind = pa.struct([("content", pa.binary()), ("bands", pa.list_(pa.int64())), ("weight", pa.float64())])

    @F.arrow_udf("struct<content:binary,bands:array<bigint>,weight:double>")
    def sign(texts: pa.Array) -> pa.Array:
        out = []
        for t in (one.as_py() for one in texts):
            hashes = text_hashes(t)
            # of the word hashes (or, without words, the text), so equal for equal words
            content = xxhash.xxh3_128_digest(hashes.tobytes() if len(hashes) else b"\0" + t.encode("utf-8", "surrogatepass"))
            grams, weights = shingles(hashes, shared.value)
            out.append({"content": content, "bands": bands(grams, weights), "weight": float(weights.sum())})
        return pa.array(out, kind)

    rows = docs.select(F.struct("*").alias("doc"), sign(plain_text(text)).alias("s"))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "doc", "s.content", "s.bands", "s.weight"), "near-rows")


def candidate_links(nodes: DataFrame) -> DataFrame:
    """Links ``a``-``b`` from each band's least text to its others."""
    rows = nodes.select("content", F.explode("bands").alias("band"))
    least = rows.groupBy("band").agg(F.min("content").alias("first"), F.count("*").alias("n")).filter("n > 1")
    return rows.join(least, "band").filter("content <> first").select(F.col("first").alias("a"), F.col("content").alias("b")).distinct()


_LINK = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _links(pairs):
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], schema=_LINK)


def verified_in_blocks(rows: DataFrame, idf, threshold: float) -> DataFrame:
    """Links among ``block, content, bands, text`` rows of bounded blocks."""
    shared = rows.sparkSession.sparkContext.broadcast(idf)

    def block_links(members):
        vectors = [shingles(text_hashes(t), shared.value) for _, _, t in members]
        root = list(range(len(members)))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        at: dict[int, list[int]] = {}
        for i, (_, own, _) in enumerate(members):
            others = sorted({j for band in own for j in at.get(band, ())})
            for j in others:
                if find(i) != find(j) and similarity(vectors[i], vectors[j]) >= threshold:
                    root[find(i)] = find(j)
                    yield members[j][0], members[i][0]
            for band in own:
                at.setdefault(band, []).append(i)

    def verify(batches):
        block, members = None, []
        for batch in batches:
            found = []
            for b, content, own, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if b != block:
                    found += block_links(members)
                    block, members = b, []
                members.append((content, own, text))
            yield _links(found)
        yield _links(list(block_links(members)))

    dealt = rows.select("block", "content", "bands", "text").repartition(partitions(rows.sparkSession), "block")
    return dealt.sortWithinPartitions("block", "content").mapInArrow(verify, "a binary, b binary")


def verified_pairs(pairs: DataFrame, idf, threshold: float) -> DataFrame:
    """Of ``a, b, text_a, text_b`` those pairs that are similar."""
    shared = pairs.sparkSession.sparkContext.broadcast(idf)

    @F.arrow_udf("double")
    def compared(a: pa.Array, text_a: pa.Array, text_b: pa.Array) -> pa.Array:
        last, vector, out = None, None, []
        for name, one, other in zip(a.to_pylist(), text_a, text_b):
            if name != last:
                last, vector = name, shingles(text_hashes(one.as_py()), shared.value)
            out.append(similarity(vector, shingles(text_hashes(other.as_py()), shared.value)))
        return pa.array(out, pa.float64())

    return pairs.withColumn("similarity", compared("a", "text_a", "text_b")).filter(F.col("similarity") >= threshold).select("a", "b")


def similar_pairs(vectors, threshold: float):
    """Places ``i < j`` of all vectors that may be similar: none is missed, few are not.

    The lesser of two weights is at most the root of their product, so products
    of roots summed over shared shingles bound what two vectors share.
    """
    sums = np.array([v[1].sum() for v in vectors])
    owner = np.repeat(np.arange(len(vectors)), [len(v[0]) for v in vectors])
    _, place, count = np.unique(np.concatenate([v[0] for v in vectors]), return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1
    kept = count[place] > 1
    owner, column, roots = owner[kept], column[place[kept]], np.sqrt(np.concatenate([v[1] for v in vectors])[kept])
    order = np.argsort(column, kind="stable")
    owner, column, roots = owner[order], column[order], roots[order]
    bound = np.zeros((len(vectors), len(vectors)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, _STEP):
        part = slice(*np.searchsorted(column, [low, low + _STEP]))
        dense = np.zeros((len(vectors), _STEP))
        dense[owner[part], column[part] - low] = roots[part]
        bound += dense @ dense.T
    near = bound >= (threshold - 1e-9) * (sums[:, None] + sums - bound)
    return np.argwhere(np.triu(near, 1)).tolist()


def verified_in_tiles(rows: DataFrame, idf, threshold: float) -> DataFrame:
    """Links among ``tile, side, content, root, text`` rows: of both sides of a tile, or within one that has a single side, but not within a root."""
    shared = rows.sparkSession.sparkContext.broadcast(idf)

    def tile_links(members):
        if len({m[2] for m in members}) < 2:
            return
        vectors, above = [shingles(text_hashes(m[3]), shared.value) for m in members], {}
        whole = len({m[0] for m in members}) == 1

        def find(root):
            while root in above:
                root = above[root]
            return root

        for i, j in similar_pairs(vectors, threshold):
            one, other = find(members[i][2]), find(members[j][2])
            if one != other and (whole or members[i][0] != members[j][0]) and similarity(vectors[i], vectors[j]) >= threshold:
                above[one] = other
                yield members[i][1], members[j][1]

    def verify(batches):
        tile, members = None, []
        for batch in batches:
            found = []
            for t, *member in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if t != tile:
                    found += tile_links(members)
                    tile, members = t, []
                members.append(member)
            yield _links(found)
        yield _links(list(tile_links(members)))

    dealt = rows.select("tile", "side", "content", "root", "text").repartition(partitions(rows.sparkSession), "tile")
    return dealt.sortWithinPartitions("tile", "side", "content").mapInArrow(verify, "a binary, b binary")


def _rooted(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of bands whose texts are not all connected by the links, with the ``root`` of each."""
    roots = components(links).withColumnRenamed("node", "content")
    rows = rows.join(roots, "content", "left").withColumn("root", F.coalesce("root", "content"))
    rows = stored(rows, "near-rooted")
    mixed = rows.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most")
    return stored(rows.join(mixed.select("band"), "band"), "near-mixed")


def tiled(rows: DataFrame, threshold: float) -> DataFrame:
    """Tiles of ``band, content, weight, root`` rows, as ``tile, side, content, root``, that have every pair of a band with different roots and weights that allow the threshold.

    Similar texts are in the same or in neighbouring weight classes. Parts have
    half of ``BLOCK_NODES`` texts on average; a root with more has parts of its own.
    """
    half = max(1, BLOCK_NODES // 2)
    width = max(1e-3, -np.log(threshold) * (1 + 1e-6)) if threshold > 0 else np.inf
    rows = rows.withColumn("class", F.floor(F.log("weight") / F.lit(float(width))))
    sizes = rows.groupBy("band", "class", "root").agg(F.count("*").alias("n")).withColumn("own", F.when(F.col("n") > half, F.col("root")))
    parts = sizes.groupBy("band", "class", "own").agg(F.ceil(F.sum("n") / half).alias("parts"))
    keyed = rows.join(sizes.drop("n"), ["band", "class", "root"]).withColumn("key", F.coalesce("own", F.lit(b"")))
    keyed = keyed.join(parts.withColumn("key", F.coalesce("own", F.lit(b""))).drop("own"), ["band", "class", "key"])
    number = F.pmod(F.xxhash64("band", "content", F.lit(1)), F.col("parts"))
    keyed = stored(keyed.select("band", "class", "key", number.alias("part"), "content", "root"), "near-parts")
    there = keyed.groupBy("band", "class", "key", "part").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    there = stored(there.select("band", "class", "least", "most", F.struct("class", "key", "part").alias("name")), "near-there")
    other = there.select("band", *[F.col(c).alias(f"{c}_b") for c in ("class", "least", "most", "name")])
    pairs = there.join(other, "band").filter("name <= name_b AND class_b - class <= 1")
    pairs = pairs.filter("least <> most OR least_b <> most_b OR least <> least_b")  # not all of one root
    pairs = pairs.select("band", "name", "name_b").withColumn("tile", F.struct("band", "name", "name_b"))
    sides = pairs.select("band", "tile", F.lit(0).alias("side"), "name").unionByName(
        pairs.filter("name <> name_b").select("band", "tile", F.lit(1).alias("side"), F.col("name_b").alias("name")))
    members = keyed.withColumn("name", F.struct("class", "key", "part")).select("band", "name", "content", "root")
    return members.join(sides, ["band", "name"]).select(F.sha2(F.to_json("tile"), 256).alias("tile"), "side", "content", "root")


def verified_in_bands(rows: DataFrame, idf, threshold: float) -> DataFrame | None:
    """Links in large blocks, band by band; None without such blocks.

    A band's texts that fit a task are all verified there. More are verified
    within random parts first; that and the comparison of all with the texts of
    most links only serve to connect much early, as every pair of a band not
    connected by then is verified in tiles.
    """
    texts = rows.select("content", "bands", "text")
    every = stored(rows.select(F.explode("bands").alias("band"), "content", "weight"), "near-bands")
    if every.isEmpty():
        return None
    sizes = every.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    sized = stored(every.join(sizes, "band"), "near-sized")
    half = max(1, BLOCK_NODES // 2)
    part = F.when(F.col("n") <= BLOCK_NODES, 0).otherwise(F.pmod(F.xxhash64("band", "content"), F.ceil(F.col("n") / half)))
    first = sized.select(F.struct("band", part.alias("part")).alias("block"), "content").join(texts, "content")
    links = stored(verified_in_blocks(first, idf, threshold), "near-links")
    many = sized.filter(F.col("n") > BLOCK_NODES).drop("n")
    if many.isEmpty():
        return links
    mixed = _rooted(many, links)
    if mixed.isEmpty():
        return links
    degree = links.select(F.explode(F.array("a", "b")).alias("content")).groupBy("content").agg(F.count("*").alias("degree"))
    hubs = mixed.join(degree, "content").groupBy("band", F.pmod(F.xxhash64("content"), F.lit(LEADERS)).alias("slot"))
    hubs = hubs.agg(F.max_by(F.struct("content", "root"), F.struct("degree", "content")).alias("hub"))
    pairs = mixed.join(hubs, "band").filter("root <> hub.root")
    pairs = pairs.select(F.least("content", "hub.content").alias("a"), F.greatest("content", "hub.content").alias("b")).distinct()
    pairs = pairs.join(texts.select(F.col("content").alias("b"), F.col("text").alias("text_b")), "b")
    pairs = pairs.join(texts.select(F.col("content").alias("a"), F.col("text").alias("text_a")), "a")
    found = stored(verified_pairs(pairs, idf, threshold), "near-links")
    if not found.isEmpty():
        links = links.unionByName(found)
        mixed = _rooted(mixed.drop("root"), links)
        if mixed.isEmpty():
            return links
    tiles = tiled(mixed, threshold).join(texts.select("content", "text"), "content")
    return links.unionByName(stored(verified_in_tiles(tiles, idf, threshold), "near-links"))


def near_classes(rows: DataFrame, idf: np.ndarray, text="text", threshold: float = SIMILARITY) -> DataFrame:
    """``content, root`` of every text that is linked to a different one."""
    nodes = rows.groupBy("content").agg(F.min("row").alias("row"), F.min_by("bands", "row").alias("bands"), F.min_by("weight", "row").alias("weight")).filter(F.size("bands") > 0)
    nodes = stored(nodes, "near-nodes")
    blocks = components(candidate_links(nodes))
    blocks = blocks.withColumnRenamed("node", "content").withColumnRenamed("root", "block")
    sizes = blocks.groupBy("block").agg(F.count("*").alias("nodes"))
    members = nodes.join(blocks.join(sizes, "block"), "content")
    texts = rows.select("row", plain_text(F.col(f"doc.{text}")).alias("text"))
    members = stored(members.join(texts, "row").select("block", "nodes", "content", "bands", "weight", "text"), "near-members")
    links = verified_in_blocks(members.filter(F.col("nodes") <= BLOCK_NODES), idf, threshold)
    more = verified_in_bands(members.filter(F.col("nodes") > BLOCK_NODES), idf, threshold)
    links = links if more is None else links.unionByName(more)
    return components(links).withColumnRenamed("node", "content")


def classes(docs: DataFrame, doc_id="doc_id", text="text", threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` as struct ``doc`` with ``row``, ``class_id`` and ``class_row``.

    ``class_id`` is the least id of the row's class and ``class_row`` the one
    row that stands for it: the first by id. Texts with the same words are
    in one class; so are equal texts without any word (empty, null). Null ids
    come after all others; a class with none but null ids has a null
    ``class_id``. Rows that repeat an id are rows of their own. An empty
    table gives no rows.
    """
    idf = inverse_frequencies(docs, text)
    rows = signed(docs, idf, text)
    own = F.struct(F.col(f"doc.{doc_id}").isNull().alias("unknown"), F.col(f"doc.{doc_id}").alias("id"), F.col("row").alias("row"))
    roots = near_classes(rows, idf, text, threshold)
    firsts = rows.groupBy("content").agg(F.min(own).alias("first")).join(roots, "content", "left")
    firsts = firsts.withColumn("root", F.coalesce("root", "content"))
    best = firsts.groupBy("root").agg(F.min("first").alias("best"))
    named = firsts.join(best, "root").select("content", F.col("best.id").alias("class_id"), F.col("best.row").alias("class_row"))
    named = stored(named, "near-classes")
    return rows.join(named, "content").select("doc", "row", "class_id", "class_row")


def deduplicated(docs: DataFrame, doc_id="doc_id", text="text", threshold: float = SIMILARITY) -> DataFrame:
    """The first document of every class, with its columns."""
    return classes(docs, doc_id, text, threshold).filter(F.col("row") == F.col("class_row")).select("doc.*")
